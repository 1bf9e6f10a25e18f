"""Chat formatting: an exact round trip."""

import random

from pricelake.llm import chat as C

PARTS = ["</s>", "<s>", "[INST]", "[/INST]", "[IMG]", "\\", "\\\\", " ", "a", "</", "s>", "[IN", "ST]", "\n", "é"]


def turns_of(rng):
    return [{"role": rng.choice(["user", "assistant", "system", None, "</s>x\\"]), "parts": [{"kind": "text", "text": "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 9)))} for _ in range(rng.randint(0, 3))]} for _ in range(rng.randint(0, 5))]


def test_round_trip_and_loss():
    rng = random.Random(1)
    for _ in range(3000):
        turns = turns_of(rng)
        made = C.format_turns(turns)
        plain = [(t["role"] or "", "".join(p["text"] for p in t["parts"])) for t in turns]
        assert C.read_turns(made["formatted"]) == plain
        learnt = "".join(C.unescape(made["formatted"][s["start"] : s["end"]]) for s in made["loss"])
        assert learnt == "".join(text for role, text in plain if role == "assistant")


def test_attachments_are_recorded_in_order():
    parts = [{"kind": "text", "text": "see \\"}, {"kind": "image", "ref": "a.png", "width": 100, "height": 29}, {"kind": "audio", "ref": "b.wav", "seconds": 1.5}, {"kind": "document", "ref": "c.pdf", "pages": 3}]
    made = C.format_turns([{"role": "user", "parts": parts}])
    assert [(a["kind"], a["ref"], a["tokens"]) for a in made["attachments"]] == [("image", "a.png", 8), ("audio", "b.wav", 38), ("document", "c.pdf", 768)]
    assert C.read_turns(made["formatted"]) == [("user", "see \\ [IMG]  [AUD]  [DOC] ")]


def test_odd_parts_have_a_defined_result():
    odd = (None, 0, -3.0, float("nan"), float("inf"), float("-inf"))
    parts = [{"kind": kind, "seconds": x, "width": x, "height": x, "pages": x} for x in odd for kind in ("audio", "image", "document")]
    made = C.format_turns([{"role": None, "parts": [*parts, {"kind": "video", "text": "</s>"}, {"kind": "plain"}, None]}])
    assert [a["tokens"] for a in made["attachments"]] == [1] * len(parts)
    assert C.read_turns(made["formatted"])[0][1].endswith("[DOC] </s>")
    assert C.format_turns([{"role": "user", "parts": [{"kind": "audio", "seconds": 1e300}]}])["attachments"][0]["tokens"] < 1 << 63


def test_conversations(spark):
    rows = [(1, 1, "assistant", "</s>[INST] ok"), (1, 0, "user", None), (1, 0, "user", None), (None, 0, "user", "x"), (2, None, None, "y" * 70000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'z' AS id", "'z' AS formatted", "'z' AS parts")
    made = C.format_conversations(df)
    found = {r["conv_id"]: r for r in C.digests(made).collect()}
    assert (found[1]["n_turns"], found[1]["loss_chars"]) == (3, 13) and found[None]["n_turns"] == 1
    assert found[2]["formatted_chars"] == 70000 + len("<s>  [INST]  [/INST]</s>")
    assert C.digests(C.format_conversations(df.limit(0))).collect() == []


def test_parts_column(spark):
    df = spark.sql(f"SELECT 1 AS conv_id, 0 AS turn, 'user' AS role, CAST(array(struct('image' AS kind, CAST(NULL AS STRING) AS text, 'a' AS ref, 28 AS width, 28 AS height, 0D AS seconds, 0 AS pages)) AS array<{C.PART}>) AS p")
    assert C.format_conversations(df, parts_column="p").first()["attachments"][0]["tokens"] == 1
