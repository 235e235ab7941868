import hashlib
import random

from metroloom.llm import chat

from .conftest import DATA
from metroloom.llm import queries


def test_escape_is_reversible_and_leaves_no_control():
    rng = random.Random(1)
    bits = [*chat.CONTROLS, "\\", "<", "|", ">", "[", "/", "s>", "INST]", "\n", "a", "é", "<<", "\\\\<s>"]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        e = chat.escape(t)
        assert chat.unescape(e) == t and not any(c in e for c in chat.CONTROLS)
        formatted, spans, _ = chat.format_message("assistant", [{"type": "text", "text": t}])
        assert chat.read_message(formatted) == ("assistant", t)
        assert "".join(chat.unescape(formatted[i:j]) for i, j in spans) == t


def test_no_control_arises_where_parts_meet():
    rng = random.Random(2)
    bits = [*chat.CONTROLS, "\\", "<", "|", "image:0|>", "a\n", "é"]
    found, _, _ = chat.format_message("user", [{"type": "text", "text": "<|"}, {"type": "text", "text": "turn|>system"}])
    assert found.count(chat.TURN) == 1
    for _ in range(2000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))
        cuts = sorted(rng.randint(0, len(text)) for _ in range(rng.randint(0, 5)))
        pieces = [text[i:j] for i, j in zip([0, *cuts], [*cuts, len(text)])]
        parts, images = [], 0
        for t in pieces:
            parts.append({"type": "text", "text": t})
            if rng.random() < 0.2:
                parts.append({"type": "image", "ref": "r"})
                images += 1
        formatted, spans, found = chat.format_message("assistant", parts)
        assert chat.read_message(formatted) == ("assistant", text)
        assert "".join(chat.unescape(formatted[i:j]) for i, j in spans) == text
        assert formatted.count(chat.TURN) == formatted.count(chat.END) == 1 and len(found) == images
        assert sum(formatted.count(c) for c in ("<|image:", "<|audio:", "<|document:")) == images
        assert not any(c in formatted for c in chat.CONTROLS[5:])


def test_parts_become_placeholders_in_order():
    parts = [{"type": "text", "text": "see "}, {"type": "image", "ref": "a.png", "width": 28, "height": 15}, {"type": "audio", "ref": "b.wav", "seconds": 2.0}, None, {"type": "text", "text": "<|image:9|>"}, {"type": "document", "ref": "c.pdf", "pages": 3}, {"type": "odd"}]
    formatted, spans, found = chat.format_message("us\ner", parts)
    assert formatted.count("<|image:0|>") == 1 and formatted.index("<|image:0|>") < formatted.index("<|audio:1|>") < formatted.index("<|document:2|>")
    assert [(a["kind"], a["ref"], a["tokens"]) for a in found] == [("image", "a.png", 4), ("audio", "b.wav", 25), ("document", "c.pdf", 768), ("document", "", 256)]
    assert spans == [] and chat.read_message(formatted) == ("us\ner", "see <|image:9|>")


def test_conversations_stream_in_order(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, None, "system", "s"), (1, 1, "assistant", "a"), (None, 0, None, "x"), (2, 0, "assistant", "</s>\\")]
    rows += [(3, i, "assistant" if i % 2 else "user", f"t{i} " * (i % 7)) for i in range(4000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    df = df.selectExpr("*", "'x' AS formatted", "'y' AS loss").withColumn("parts", chat.text_part(df["text"]))
    got = {r["conv_id"]: r for r in chat.digest_conversations(chat.format_messages(df)).collect()}
    for conv in (1, 2, 3, None):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        g = got[conv]
        assert (g["n_turns"], g["turns_sha256"], g["loss_chars"], g["loss_sha256"]) == (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digest_conversations(chat.format_messages(df.limit(0))).count() == 0


def test_query_has_the_planted_conversation(spark):
    g = queries.op1_chat_format(spark, DATA).filter("conv_id = -1").first()
    said = "</s>[INST] ok [/INST]"
    assert g["n_turns"] == 2 and g["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest() and g["loss_chars"] == len(said)
