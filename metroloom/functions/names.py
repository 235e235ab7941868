"""Resolution and normalisation of names as column expressions (F2-F6, P3): no Python on the rows."""

from __future__ import annotations

import functools
import re
import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Overrides:
    """Curated decisions on names (S7). Defaults: nothing is curated but the stop words."""

    node_names: dict[int, str] = field(default_factory=dict)
    parenthetical: list[str] = field(default_factory=list)
    trailing_words: list[str] = field(default_factory=list)
    bracketed: list[str] = field(default_factory=list)  # patterns that begin with ^
    display_names: dict[str, tuple[str, str | None]] = field(default_factory=dict)
    aliases: dict[str, list[str]] = field(default_factory=dict)
    stop_words: list[str] = field(default_factory=list)

    @classmethod
    def from_json(cls, raw: dict) -> Overrides:
        """Keys that begin with ``$`` are comments; entries without a name are left out."""
        plain = lambda d: {k: v for k, v in (d or {}).items() if not k.startswith("$")}
        strip = raw.get("stripSuffixes") or {}
        return cls(
            node_names={int(k): v["name"] for k, v in plain(raw.get("nodeNames")).items() if isinstance(v, dict) and v.get("name")},
            parenthetical=list(strip.get("parenthetical") or []),
            trailing_words=list(strip.get("trailingWords") or []),
            bracketed=list(strip.get("bracketedPatterns") or []),
            display_names={k: (v["name"], v.get("short")) for k, v in plain(raw.get("displayNames")).items() if isinstance(v, dict) and v.get("name")},
            aliases={k: v for k, v in plain(raw.get("aliases")).items() if isinstance(v, list)},
            stop_words=list((raw.get("normStopWords") or {}).get("words") or []),
        )


@functools.lru_cache(maxsize=1)
def _bases() -> tuple[str, str]:
    """Characters that decompose into an ASCII letter or digit and combining marks, and those letters."""
    found = {}
    for c in map(chr, range(0x80, 0x2FFFF)):
        d = unicodedata.normalize("NFD", c)
        if d != c and d[0].isascii() and d[0].isalnum() and all("̀" <= m <= "ͯ" for m in d[1:]):
            found[c] = d[0]
    return "".join(found), "".join(found.values())


def strip_disambiguators(name: Column, o: Overrides) -> Column:
    """Drops listed parentheses, brackets with listed contents and trailing words, then tidies blanks (F2)."""
    if o.parenthetical:
        listed = "|".join(map(re.escape, o.parenthetical))
        name = F.regexp_replace(name, rf"(?U)\s*\(\s*(?:{listed})\s*\)", "")
    for p in o.bracketed:
        name = F.regexp_replace(name, rf"(?U)\s*\[\s*(?:{p.removeprefix('^')})(?:[^\]]*[^\s\]])?(?<!\s)\s*\]", "")
    for w in o.trailing_words:
        name = F.regexp_replace(name, rf"(?iU)\s+{re.escape(w)}\z", "")
    return F.regexp_replace(F.regexp_replace(name, r"(?U)\s{2,}", " "), r"(?U)^\s+|\s+\z", "")


def normalise(name: Column, stop_words: list[str]) -> Column:
    """The matching key (F3): accents, case, signs, stop words and blanks removed. May be empty."""
    fro, to = _bases()
    bare = F.lower(F.regexp_replace(F.translate(name, fro, to), r"[\x{300}-\x{36f}]", ""))
    plain = F.when(name.rlike(r"[^\x00-\x7F]"), bare).otherwise(F.lower(name))  # ASCII has no accents to look up
    plain = F.regexp_replace(plain, "[^a-z0-9]", " ")
    if stop_words:
        plain = F.regexp_replace(plain, rf"\b(?:{'|'.join(map(re.escape, stop_words))})\b", " ")
    return F.replace(plain, F.lit(" "), F.lit(""))


def lookup_map(pairs: dict) -> Column:
    """A small curated table as a literal map."""
    flat = [F.lit(x) for kv in pairs.items() for x in kv]
    return F.create_map(*flat) if flat else F.lit(None).cast("map<string,string>")


def resolve(nodes: DataFrame, o: Overrides, node_id: str = "id", tags: str = "tags") -> DataFrame:
    """Adds display, short, norm, name_source, raw_name (F4, F5); all null where no name is found.

    Order: curated node, ``name``, ``name:en``, ``ref``; empty strings fall through. A listed raw
    name is replaced as it is; any other is stripped."""
    tag = lambda k: F.nullif(F.col(tags)[k], F.lit(""))
    curated = lookup_map({str(k): v for k, v in o.node_names.items()})[F.col(node_id).cast("string")]
    raw = F.coalesce(curated, tag("name"), tag("name:en"), tag("ref"))
    source = F.when(curated.isNotNull(), "curated").when(tag("name").isNotNull(), "osm-name").when(tag("name:en").isNotNull(), "osm-name-en").when(tag("ref").isNotNull(), "ref-fallback")
    seen = F.when(source == "ref-fallback", F.lit(None)).when(source == "osm-name-en", tag("name:en")).otherwise(tag("name"))
    full = lookup_map({k: v[0] for k, v in o.display_names.items()})[raw]
    short = lookup_map({k: v[1] for k, v in o.display_names.items() if v[1]})[raw]
    named = nodes.withColumns({"display": F.coalesce(full, strip_disambiguators(raw, o)), "short": short, "name_source": F.when(full.isNotNull(), "curated").otherwise(source), "raw_name": F.when(full.isNotNull(), F.coalesce(seen, raw)).otherwise(seen)})
    return named.withColumn("norm", normalise(F.col("display"), o.stop_words))


def aliases_of(df: DataFrame, spark: SparkSession, o: Overrides) -> DataFrame:
    """Adds the curated aliases of ``display``, an empty array if there are none."""
    table = spark.createDataFrame(list(o.aliases.items()), "display string, aliases array<string>")
    return df.join(F.broadcast(table), "display", "left").withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))  # a curated table


#: Fixed value: names of parts of buildings, which say nothing without their building.
PART_OF_BUILDING = r"(?i)^(building|bldg|wing|tower|block|plot|shop|gala|room|flat)\s*[-.no#]*\s*\d+[a-z]?$"


def is_usable(name: Column) -> Column:
    """A name worth an entry."""
    t = F.regexp_replace(name, r"(?U)^\s+|\s+\z", "")
    return F.coalesce(F.length(t).between(3, 60) & t.rlike("[A-Za-z]") & ~t.rlike(PART_OF_BUILDING) & ~t.rlike("(?i)^[a-z]$"), F.lit(False))
