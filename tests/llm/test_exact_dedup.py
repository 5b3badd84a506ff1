from tablework.llm import exact_dedup
from tablework.llm.queries import QUERIES

ROWS = [
    (1, "a b"), (2, "ab"), (3, " a\tb\n"), (4, "a\xa0b"), (5, None), (6, ""), (7, " \n"), (8, "x" * 200_000), (9, "x" * 200_000 + " "),
    (10, "same"), (10, "same"), (None, "lone"), (None, "ab     "), (11, "ab     "),
]


def expected():
    groups = {}
    for doc_id, text in ROWS:
        text = text or ""
        groups.setdefault("".join(c for c in text if c not in " \t\n\x0b\x0c\r"), []).append((-len(text), doc_id is None, doc_id or 0))
    found = []
    for doc_id, text in ROWS:
        text = text or ""
        group = groups["".join(c for c in text if c not in " \t\n\x0b\x0c\r")]
        best = min(group)
        found.append((doc_id, best[2] if not best[1] else None, len(group), (-len(text), doc_id is None, doc_id or 0) == best))
    return sorted(found, key=str)


def test_marks(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "'x' as `__salt`", "1 as rows").repartition(5)
    for salts in (1, 16):
        found = exact_dedup.mark_copies(rows.drop("__salt"), salts=salts).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found), key=str) == expected()


def test_kept_rows(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "doc_id + 1 as other")
    kept = exact_dedup.deduplicate(rows).collect()
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept) == [-1, 4, 7, 9, 10, 11]
    assert kept[0].asDict().keys() == {"doc_id", "text", "other"}
    assert exact_dedup.deduplicate(rows.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, plan):
    text = plan(QUERIES["op10_exact_dedup"](spark, "/root/testdata/sf0.001"))
    assert "Python" not in text and "Arrow" not in text
