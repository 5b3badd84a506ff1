import gc
import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tablework.llm import alignment
from tablework.llm import words as W
from tablework.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    a_path, b_path = alignment.tokenizer_paths()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path)


def plain(libraries, text):
    """Groups and links of a whole text, token by token."""
    a, b = libraries
    if not text:
        return [], []
    symbols = alignment._byte_symbols()
    letters = {s: i for i, s in enumerate(symbols)}
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(letters[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids
    ]
    raw = (" " + text).encode()
    if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
        return [], []
    groups, links, group = [], [], ([], [])
    i = j = x = y = 0
    x, y = len(a_bytes[0]), len(b_bytes[0])
    group = ([a_ids[0]], [b_ids[0]])
    while True:
        links.append((a_ids[i], b_ids[j]))
        if x == y:
            groups.append(group)
            i, j = i + 1, j + 1
            if i == len(a_ids):
                break
            x, y = x + len(a_bytes[i]), y + len(b_bytes[j])
            group = ([a_ids[i]], [b_ids[j]])
        elif x < y:
            i += 1
            x += len(a_bytes[i])
            group[0].append(a_ids[i])
        else:
            j += 1
            y += len(b_bytes[j])
            group[1].append(b_ids[j])
    return groups, links


def spelled(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def expected(libraries, rows):
    found = [(doc_id, *plain(libraries, text)) for doc_id, text in rows]
    count = Counter(link for _, _, links in found for link in links)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    result = []
    for doc_id, groups, links in found:
        text = spelled(groups)
        result.append(
            (
                doc_id,
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                len(links),
                sum(count[link] == best[link[1]] for link in links),
                sum(count[link] for link in links),
                hashlib.sha256(text.encode()).hexdigest() if text else "",
            )
        )
    return sorted(result, key=str), count


ODD = [
    (1, None),
    (2, ""),
    (3, " "),
    (4, "  two  spaces \n\n and\tlines \r\n end  "),
    (5, "<|endoftext|> and <s> </s> <unk> <0x41> [PAD]"),
    (6, "a ▁mark here"),
    (7, "日本語 の 文章 🙂🙃 é ñandú — “quotes” Ω x  y ​z ﻿q"),
    (8, "don't can't we'll I'M 12 345 3.14 ,. ;; _x"),
    (8, "don't can't we'll I'M 12 345 3.14 ,. ;; _x"),
    (9, "\x00 \x01\x1c \x1f x \x85 y ᠎ z"),
    (10, "wordwithoutanyspace" * 300),
    (11, "long text of many words " * 3_000),
    (None, "no id"),
]


def test_identity_map(libraries):
    tool = alignment.aligner(alignment.tokenizer_paths())
    assert tool.cuts
    pairs = [(a, b) for a, b in enumerate(tool.same_id.tolist()) if b >= 0]
    assert len(pairs) > 10_000 and all(tool.a_bytes[a] == tool.b_bytes[b] for a, b in pairs)
    others = set(tool.b_bytes[3:])
    assert not any(t in others for t, b in zip(tool.a_bytes, tool.same_id, strict=True) if b < 0)


def test_query_equals_whole_texts(spark, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = sorted((tuple(r) for r in QUERIES["op13_alignment"](spark, SF).collect()), key=str)
    assert found == expected(libraries, rows)[0]


@pytest.mark.parametrize("limit", [1, 5_000, W.SLICE_BYTES])
def test_odd_rows_in_slices_of_any_size(spark, libraries, monkeypatch, limit):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 AS n_a", "'x' AS slice").repartition(2)
    want, count = expected(libraries, ODD)
    monkeypatch.setattr(W.gathered, "__defaults__", ("text", limit))
    found = sorted((tuple(r) for r in alignment.digests(docs).collect()), key=str)
    assert found == want
    if limit > 1:
        pairs = {(r.a_id, r.b_id): r.links for r in alignment.pair_counts(docs).collect()}
        assert pairs == dict(count)


def test_whole_texts_where_cuts_are_not_known(libraries):
    import pyarrow as pa

    tool = alignment.Aligner(*alignment.tokenizer_paths())
    texts = pa.array([t or "" for _, t in ODD[:10]])
    cut = alignment.Slice(tool, texts)
    tool.cuts = False
    tool.store = alignment.Store()
    whole = alignment.Slice(tool, texts)
    assert cut.groups == whole.groups and (cut.numbers == whole.numbers).all()


def test_align_keeps_columns(spark, libraries):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "'x' AS slice")
    rows = alignment.align(docs).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        groups, links = plain(libraries, r.text)
        assert (r.groups, r.n_groups, r.n_links, r.slice) == (spelled(groups), len(groups), len(links), "x")
    assert alignment.align(docs.limit(0)).count() == 0
    assert alignment.digests(docs.limit(0)).count() == 0 and alignment.pair_counts(docs.limit(0)).count() == 0
    only = docs.where("doc_id < 3")
    assert alignment.digests(only).count() == 2
    with pytest.raises(ValueError):
        alignment.align(docs.withColumnRenamed("slice", "n_a"))


def invented(n, letters, seed):
    """Different words, nearly all of them."""
    pick = random.Random(seed)
    return ["".join(pick.choices("abcdefghiklmnoprstuvwz", k=letters)) for _ in range(n)]


def held(work):
    """Bytes that are still held after ``work``."""
    gc.collect()
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    work()
    gc.collect()
    kept = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    return kept


def test_what_a_worker_remembers_is_small():
    tool = alignment.Aligner(*alignment.tokenizer_paths())
    words = invented(40_000, 7, 1)
    texts = pa.array([" ".join(words[i : i + 200]) for i in range(0, len(words), 200)])
    assert held(lambda: alignment.Slice(tool, texts)) < 220 * len(set(words))


def test_long_chunks_are_forgotten_by_their_bytes(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_BYTES", 1 << 20, raising=False)
    tool = alignment.Aligner(*alignment.tokenizer_paths())
    slices = [["-".join(invented(200, 7, 100 * i + k)) for k in range(100)] for i in range(12)]
    groups = []
    kept = held(lambda: groups.extend(alignment.Slice(tool, pa.array(texts)).groups[0] for texts in slices))
    assert kept < 6 << 20
    assert [str(g) for g in groups] == [spelled(plain(libraries, texts[0])[0]) for texts in slices]


def test_slices_travel_in_small_rows(spark, libraries):
    words = invented(120_000, 6, 2)
    rows = [(i, " ".join(words[i : i + 300])) for i in range(0, len(words), 300)]
    docs = spark.createDataFrame([*rows, (None, None), ((1 << 62) + 1, "one more")], "doc_id long, text string").coalesce(1)
    slices = alignment.slices_of(docs, "text", alignment.tokenizer_paths()).collect()
    assert len({r["slice"] for r in slices}) == 1
    assert max(sum(8 * len(v) if isinstance(v, list) else len(v) for v in r if hasattr(v, "__len__")) for r in slices) < 1 << 20
    found = sorted((tuple(r) for r in alignment.digests(docs).collect()), key=str)
    assert found == expected(libraries, [tuple(r) for r in docs.collect()])[0]
