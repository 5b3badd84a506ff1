"""Rendering of rows as sentences, and hashed word weights of texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablework.functions.values import money_text


def _known(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("unknown"))


def order_sentence() -> Column:
    """One sentence per part of a flat order; missing parts read 'unknown'."""
    # Wording of the six parts.
    return F.concat_ws(
        ". ",
        F.concat(F.lit("Order "), _known("OrderId")),
        F.concat(F.lit("Customer: "), _known("CustomerId")),
        F.concat(F.lit("Status: "), _known("Status")),
        F.concat(F.lit("Amount: $"), money_text("TotalAmount")),
        F.concat(F.lit("Ship to: "), _known("ShipCity"), F.lit(", "), _known("ShipCountry")),
        F.concat(
            F.lit("Items: "),
            F.coalesce(F.col("LineCount"), F.lit(0)).cast("string"),
            F.lit(" line items"),
        ),
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_buckets(text: Column | str, dim: int) -> Column:
    """The bucket of every word, in the order of the text: array of bigint.

    A word is a run of a-z and 0-9 in the lower-cased text; its bucket is the
    first 32 bits of its md5 modulo ``dim``.
    """
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    words = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % dim)


def hashed_words(text: Column | str, dim: int) -> Column:
    """Unit-length word counts over hashed buckets: array of (bucket, weight), by bucket.

    Counting sorts the buckets and takes the distances between the places where
    they change, so the cost grows with the words and not with their square. A
    text without words has no entries.
    """
    buckets = word_buckets(text, dim)

    def starts(ordered: Column) -> Column:
        placed = F.transform(ordered, lambda b, i: F.struct(b.alias("bucket"), i.alias("at")))
        return F.filter(placed, lambda e: (e["at"] == 0) | (F.get(ordered, e["at"] - 1) != e["bucket"]))

    def counted(ordered: Column) -> Column:
        def count(first: Column) -> Column:
            after = lambda j: F.coalesce(F.get(first, j + 1)["at"], F.size(ordered))
            return F.transform(first, lambda e, j: F.struct(e["bucket"].alias("bucket"), (after(j) - e["at"]).alias("n")))

        return _let(starts(ordered), count)

    def weighted(counts: Column) -> Column:
        squares = F.aggregate(counts, F.lit(0.0), lambda total, e: total + e["n"] * e["n"])
        return _let(
            F.sqrt(squares),
            lambda norm: F.transform(
                counts, lambda e: F.struct(e["bucket"].alias("bucket"), (e["n"] / norm).cast("float").alias("weight"))
            ),
        )

    return _let(_let(F.array_sort(buckets), counted), weighted)


def dense_vector(entries: Column | str, dim: int) -> Column:
    """The vector of ``dim`` numbers whose non-zero ones are in ``entries`` (ascending buckets)."""
    entries = F.col(entries) if isinstance(entries, str) else entries
    zeros = lambda n: F.array_repeat(F.lit(0.0).cast("float"), n.cast("int"))

    def fill(given: Column) -> Column:
        # Zeros from the entry before up to each entry, and after the last one.
        before = lambda i: F.coalesce(F.get(given, i - 1)["bucket"], F.lit(-1).cast("bigint"))
        parts = F.transform(given, lambda e, i: F.concat(zeros(e["bucket"] - before(i) - 1), F.array(e["weight"])))
        last = F.coalesce(F.get(given, F.size(given) - 1)["bucket"], F.lit(-1).cast("bigint"))
        return F.concat(F.flatten(parts), zeros(F.lit(dim) - last - 1))

    return _let(entries, fill)
