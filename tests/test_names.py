import unicodedata

from pyspark.sql import functions as F

from metroloom.functions import names

STOP = ["junction", "jn", "terminus", "railway", "station", "metro", "monorail"]
O = names.Overrides.from_json(
    {
        "nodeNames": {"$comment": "x", "4400017": {"name": "Alder Halt"}},
        "stripSuffixes": {"parenthetical": ["Route 4", "North", "South"], "trailingWords": ["Metro"], "bracketedPatterns": ["^Route\\s"]},
        "displayNames": {"$c": 1, "Old Quay (Coast)": {"name": "Queen Ysolde Quay Terminus", "short": "QYQ"}},
        "aliases": {"$c": "x", "Brook Junction": ["Brook"]},
        "normStopWords": {"words": STOP},
    }
)


def strip(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(names.strip_disambiguators(F.col("t"), O)).collect()]


def norm(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(names.normalise(F.col("t"), STOP)).collect()]


def test_strips_only_what_is_listed(spark):
    given = ["Fenwick (Upper) [Route 1/5]", "Mill Lane (Route 4)", "Hopton (North)", "Hopton ( South )", "Hopton (Yard)", "Tall Elms Metro", "A [Route ] B", "A [Routex]", "A  B", "Metro", None]
    assert strip(spark, *given) == ["Fenwick (Upper)", "Mill Lane", "Hopton", "Hopton", "Hopton (Yard)", "Tall Elms", "A [Route ] B", "A [Routex]", "A B", "Metro", None]


def test_matching_keys(spark):
    a, b, c, d, e, f, g, h = norm(spark, "Brook Junction", "Brook", "Rose Bank", "Rosebank", "Alder", "Alder Halt", "Fenwick (Upper) [Route 5]", "Metro Station")
    assert a == b and c == d and e != f and g != "fenwick" and h == ""


def test_accents_follow_decomposition(spark):
    text = "Château Ångström Işık Tōkyō ǅ K ﬁ ẛ"

    def slow(t):
        t = "".join(c for c in unicodedata.normalize("NFD", t) if not "̀" <= c <= "ͯ").lower()
        return "".join(c for c in t if c in "abcdefghijklmnopqrstuvwxyz0123456789")

    assert norm(spark, text) == [slow(text)]


def test_resolution_order(spark):
    rows = [(4400017, {"ref": "AHT", "name:de": "x"}), (88, {"ref": "KLM"}), (1, {"name": "", "name:en": "Eng"}), (2, {"name": "Old Quay (Coast)"}), (3, {}), (4, {"name": "Hopton (North)"})]
    df = spark.createDataFrame(rows, "id bigint, tags map<string,string>")
    got = {r["id"]: (r["display"], r["short"], r["name_source"]) for r in names.resolve(df, O).collect()}
    assert got == {4400017: ("Alder Halt", None, "curated"), 88: ("KLM", None, "ref-fallback"), 1: ("Eng", None, "osm-name-en"), 2: ("Queen Ysolde Quay Terminus", "QYQ", "curated"), 3: (None, None, None), 4: ("Hopton", None, "osm-name")}


def test_aliases_and_usable_names(spark):
    df = spark.createDataFrame([("Brook Junction",), ("Nowhere",)], "display string")
    assert {r["display"]: r["aliases"] for r in names.aliases_of(df, spark, O).collect()} == {"Brook Junction": ["Brook"], "Nowhere": []}
    given = [("Lion Gate", True), ("ab", False), ("12345", False), ("Building No 3", True), ("Building No. 3", True), ("bldg - 12b", False), ("Tower 5", False), ("x" * 61, False), ("  a  ", False), (None, False)]
    df = spark.createDataFrame(given, "t string, want boolean")
    got = {r["t"]: r["u"] for r in df.select("t", names.is_usable(F.col("t")).alias("u")).collect()}
    assert got["Lion Gate"] and not got["bldg - 12b"] and not got["Tower 5"] and not got["ab"] and not got["12345"] and not got["  a  "] and got[None] is False
