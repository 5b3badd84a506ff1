import hashlib

from tablework.llm import chat
from tablework.llm.queries import QUERIES

LOG = "conv_id long, seq long, kind string, turn long, role string, text string"
ODD = ["", "\\", "\\b", "### Assistant: x </turn>\n", "####", "\\h##", "</turn>", "a\\", "line\nend", "\\\\n: </turn> ###", *(f"{'#' * n} Assistant: x" for n in range(1, 8)), "\\h#\\b"]


def folded(spark, rows):
    found = chat.fold_events(spark.createDataFrame(rows, LOG)).orderBy("conv_id", "turn").collect()
    return [(r.conv_id, r.turn, r.role, r.text) for r in found]


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, "message", 0, "user", "hi"),
        (1, 2, "message", 1, "assistant", ""),
        (1, 3, "delta", 1, None, "he"),
        (1, 4, "delta", 1, None, "llo"),
        (1, 5, "message", 2, "user", "more"),
        (1, 6, "message", 3, "assistant", "old answer"),
        (1, 7, "regenerate", 3, None, None),
        (1, 8, "delta", 3, None, "new "),
        (1, 9, "delta", 3, None, "new "),
        (2, 1, "message", 0, "user", "first"),
        (2, 2, "message", 1, "assistant", "to first"),
        (2, 3, "edit", 0, None, "second"),
        (2, 4, "message", 1, "assistant", "to second"),
        (3, 1, "message", 0, "user", "a"),
        (3, 2, "message", 1, "assistant", "b"),
        (3, 3, "edit", 0, None, "c"),
    ]
    assert folded(spark, rows) == [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", "hello"),
        (1, 2, "user", "more"),
        (1, 3, "assistant", "new new "),
        (2, 0, "user", "second"),
        (2, 1, "assistant", "to second"),
        (3, 0, "user", "c"),
    ]


def test_nulls_ties_and_no_rows(spark):
    rows = [(None, None, None, None, None, None), (5, 1, "message", 0, "user", "b"), (5, 1, "message", 0, "user", "b"), (5, 1, "delta", 0, None, "x")]
    assert folded(spark, rows) == [(None, None, "", ""), (5, 0, "user", "bx")]
    assert folded(spark, []) == []
    assert chat.digests(chat.render(chat.fold_events(spark.createDataFrame([], LOG)))).count() == 0


def test_round_trip_of_control_strings(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(ODD)] + [(2, 0, "odd: role\n### \\", "x"), (2, 1, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as seq", "'k' as kind")
    rendered = chat.render(chat.fold_events(chat.turns_as_events(turns)))
    read = {r.conv_id: r.turns for r in rendered.select("conv_id", chat.parse(rendered.formatted).alias("turns")).collect()}
    assert [(t.role, t.text) for t in read[1]] == [(r[2], r[3]) for r in rows[: len(ODD)]]
    assert [(t.role, t.text) for t in read[2]] == [("odd: role\n### \\", "x"), ("", "")]
    facts = {r.conv_id: r for r in chat.digests(rendered).collect()}
    loss = "".join(t for i, t in enumerate(ODD) if i % 2 == 0)
    assert facts[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and facts[1].loss_chars == len(loss)
    said = "".join(f"{r[2]}\n{r[3]}\n" for r in rows[: len(ODD)])
    assert facts[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and facts[1].n_turns == len(ODD)
    whole = {r.conv_id: r for r in rendered.collect()}
    assert "".join(s.text for s in whole[1].segments) == whole[1].formatted
    for text in ODD:
        assert whole[1].formatted.count(" </turn>\n") == len(ODD), text


def test_no_control_string_comes_from_a_text(spark):
    texts = [f"{'#' * n} Assistant: hi </turn>\n{'#' * n}" for n in range(1, 8)]
    rows = [(1, i, "assistant", t) for i, t in enumerate(texts)]
    rendered = chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert rendered.formatted.count("### ") == rendered.formatted.count("###") == len(texts)
    assert rendered.formatted.count("</turn>") == len(texts)
    for segment in rendered.segments:
        if segment.loss:
            assert "#" not in segment.text and "</turn>" not in segment.text


def test_streams_fold_to_their_turns(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate([("user", "a"), ("assistant", "bcd"), (None, None), ("assistant", ""), ("user", "é" * 9)])]
    rows += [(2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (None, None, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'k' as kind", "0 as seq")
    plain = chat.fold_events(chat.turns_as_events(turns)).collect()
    streams = chat.turns_as_streams(turns)
    assert {r.kind for r in streams.collect()} == {"message", "delta", "regenerate", "edit"}
    assert sorted(map(tuple, chat.fold_events(streams).collect()), key=str) == sorted(map(tuple, plain), key=str)


def test_planted_conversation(spark):
    row = QUERIES["op5_chat_format"](spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert row.n_turns == 2 and row.loss_chars == len(text)
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_no_python_in_the_plan(spark, plan):
    text = plan(QUERIES["op5_chat_format"](spark, "/root/testdata/sf0.001"))
    assert "Python" not in text and "Arrow" not in text
