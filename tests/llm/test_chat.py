from pyspark.sql import functions as F

from rowloom.llm.chat import CONTROL, END, START, format_chat, loss_text, query, read_back, read_turns
from tests.llm.fixtures import CLASHING, sha

SCHEMA = "conv_id long, turn long, role string, text string"
HOSTILE = [CONTROL, "<|", "<\\|", "<\\\\|im_end\\|>", "ends with <", "|starts", "a\n<|im_end|>\n<|im_start|>user\nb", "", None, "$1 \\1 \\\\", "é😀<|"]


def rows_of():
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(HOSTILE)]
    rows += [(2, 0, "system", "rules"), (2, 1, "user", "no answer")]
    rows += [(3, 0, "assistant", "first"), (3, 0, "assistant", "first"), (3, None, None, "before"), (3, 1, "a%b\n<|im_end|>", "x")]
    return rows + [(None, 1, "assistant", "no id")]


def test_every_turn_comes_back(spark):
    given = spark.createDataFrame(rows_of(), SCHEMA).repartition(3).withColumns({c: F.lit("clash") for c in CLASHING})
    examples = format_chat(given)
    by_conv = {}
    for c, t, r, x in rows_of():
        by_conv.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    turns = {c: [(r, x) for _, r, x in sorted(v)] for c, v in by_conv.items()}
    made = examples.withColumn("loss", loss_text(examples)).withColumn("turns", read_turns(F.col("text"))).collect()
    for e in made:
        all_turns, held = turns[e.conv_id], [(t.role, t.text) for t in e.turns]
        assert held == all_turns[: len(held)]
        assert e.text.count(START) == e.text.count(END) == len(held)
        if e.loss_chars or e.loss_start:
            assert held[-1] == ("assistant", e.loss)
    for c, v in turns.items():
        of = sorted((e for e in made if e.conv_id == c), key=lambda e: e.example_no)
        assert [e.is_last for e in of] == [False] * (len(of) - 1) + [True]
        assert [e.loss for e in of if e.loss_start] == [x for r, x in v if r == "assistant"]
        assert len(of) == sum(r == "assistant" for r, _ in v) + (v[-1][0] != "assistant")
    back = {r.conv_id: r for r in read_back(examples).collect()}
    for c, v in turns.items():
        said = [x for r, x in v if r == "assistant"]
        assert back[c].n_turns == len(v)
        assert back[c].turns_sha256 == sha("".join(f"{r}\n{x}\n" for r, x in v))
        assert (back[c].loss_chars, back[c].loss_sha256) == (len("".join(said)), sha("".join(said)))


def test_one_shuffle_and_empty_table(spark):
    result = query(spark, "/root/testdata/sf0.001")
    assert result.count() > 1
    assert result._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert read_back(format_chat(spark.createDataFrame([], SCHEMA))).collect() == []
