"""Removal of repeated passages: Rabin-Karp hashes of every window of a fixed number of words, counted over all texts.

Texts are dealt into groups of a few megabytes by a hash of their content. Each group hashes all its windows, drops the
repeats it can see itself, and sends the rest as byte strings, one for each bucket of the hash space; a bucket finds the
hashes that came twice or were marked, and answers each group with a bit per hash. The group lays the windows out again
in the same order, and merges the repeated ones into maximal intervals. Groups and buckets have a fixed size, so there
are more of them for more data, and a window that occurs a million times is sent once per group.

Two windows are taken as equal if 64 bits of one polynomial hash and the bucket, from a second one, are equal: at a
million buckets, 84 bits.

Edge cases: a null text has no words and stays null; texts shorter than a window lose nothing; a window that overlaps
its own copy counts; repeated rows are copies of each other; an empty table gives no rows; null ids are ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.llm.frames import text_bytes
from phenoloom.llm.words import REMEMBERED_WORDS, covered, inside, mixed, two_windows

WIDTH = 35
#: Bytes of text in a group, and windows in a bucket, on average.
GROUP_BYTES, BUCKET_WINDOWS = 2 << 20, 500_000
#: Bytes of text that a word takes at least, on average; it only sizes the buckets.
WORD_BYTES = 6


class _Group:
    """The texts of a group in the order of their content, with the hashes of their windows."""

    def __init__(self, table: pa.Table, width: int, buckets: int):
        order = [(x is not None, x or "", k is not None, k or 0, i) for i, (k, x) in enumerate(zip(table.column("k").to_pylist(), table.column("x").to_pylist(), strict=True))]
        self.rows = [x[-1] for x in sorted(order)]
        self.words = [order[i][1].encode().split() for i in self.rows]
        self.lengths = np.array([len(x) for x in self.words], np.int64)
        flat = REMEMBERED_WORDS.of([w for x in self.words for w in x])
        by, dealt = two_windows(width)
        self.starts = np.flatnonzero(inside(self.lengths, width))
        self.hashes = by.of(flat)[self.starts]
        bucket = (mixed(dealt.of(flat)[self.starts]) % np.uint64(buckets)).astype(np.int64)
        # distinct windows in the order of bucket and hash; place: where each window's distinct one stands
        order = np.lexsort((self.hashes, bucket))
        h, b = self.hashes[order], bucket[order]
        new = np.ones(len(order), bool)
        new[1:] = (h[1:] != h[:-1]) | (b[1:] != b[:-1])
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.cumsum(new) - 1
        self.distinct, self.bucket = h[new], b[new]
        self.twice = np.bincount(self.place, minlength=len(self.distinct)) > 1

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        first = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        return first, np.append(first[1:], len(self.bucket))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, carry: tuple[str, ...] = ()) -> DataFrame:
    """``key, *carry, text, n_words, n_removed, kept_text, removed``: ``removed`` holds the maximal intervals of removed words.

    ``kept_text`` joins the kept words by one space; it is null for a null text.
    """
    size = text_bytes(docs, text)
    groups = max(1, -(-size // GROUP_BYTES))
    buckets = max(1, -(-size // (WORD_BYTES * BUCKET_WINDOWS)))
    names = [f"c{i}" for i in range(len(carry))]
    dealt = docs.select(
        F.pmod(F.xxhash64(key, text), F.lit(groups)).alias("g"), F.col(key).alias("k"), F.col(text).alias("x"), *[F.col(c).alias(n) for c, n in zip(carry, names, strict=True)]
    )

    def send(table: pa.Table) -> pa.Table:
        group = _Group(table, width, buckets)
        first, last = group.bounds()
        return pa.table(
            {
                "b": pa.array(group.bucket[first], pa.int64()),
                "g": pa.array([table.column("g")[0].as_py()] * len(first), pa.int64()),
                "h": pa.array([group.distinct[i:j].tobytes() for i, j in zip(first, last, strict=True)], pa.binary()),
                "m": pa.array([np.packbits(group.twice[i:j]).tobytes() for i, j in zip(first, last, strict=True)], pa.binary()),
            }
        )

    def answer(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in table.column("h").to_pylist()]
        sizes = np.array([len(x) for x in parts])
        marked = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(table.column("m").to_pylist(), sizes, strict=True)])
        flat = np.concatenate(parts)
        order = np.argsort(flat, kind="stable")
        ranked = flat[order]
        place = np.zeros(len(order), np.int64)
        place[order] = np.cumsum(np.r_[0, ranked[1:] != ranked[:-1]])
        repeated = np.bincount(place, 1 + marked)[place] > 1
        cuts = np.split(repeated, np.cumsum(sizes)[:-1])
        keep = [i for i, x in enumerate(cuts) if x.any()]
        return pa.table(
            {
                "g": table.column("g").take(pa.array(keep, pa.int64())).combine_chunks(),
                "b": table.column("b").take(pa.array(keep, pa.int64())).combine_chunks(),
                "m": pa.array([np.packbits(cuts[i]).tobytes() for i in keep], pa.binary()),
            }
        )

    def drop(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _empty
        group = _Group(table, width, buckets)
        first, last = group.bounds()
        at = {int(group.bucket[i]): (int(i), int(j)) for i, j in zip(first, last, strict=True)}
        repeated = np.zeros(len(group.distinct), bool)
        for b, m in zip(answers.column("b").to_pylist(), answers.column("m").to_pylist(), strict=True):
            i, j = at[b]
            repeated[i:j] = np.unpackbits(np.frombuffer(m, np.uint8), count=j - i)
        gone = covered(group.starts[repeated[group.place]], int(group.lengths.sum()), width)
        ends = np.cumsum(group.lengths)
        n_removed, kept, spans = [], [], []
        texts = table.column("x")
        for row, words, end in zip(group.rows, group.words, ends.tolist(), strict=True):
            mask = gone[end - len(words) : end]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
            n_removed.append(int(mask.sum()))
            spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
            if texts[row].as_py() is None:
                kept.append(None)
            elif len(edges):
                kept.append(b" ".join([words[i] for i in np.flatnonzero(~mask)]).decode())
            else:
                kept.append(b" ".join(words).decode())
        out = table.select(["k", *names, "x"]).take(pa.array(group.rows, pa.int64()))
        out = out.append_column("n_words", pa.array(group.lengths)).append_column("n_removed", pa.array(n_removed, pa.int64()))
        return out.append_column("kept_text", pa.array(kept, pa.string())).append_column("removed", pa.array(spans, _spans))

    masks = (
        dealt.select("g", "k", "x", *names).groupBy("g").applyInArrow(send, "b bigint, g bigint, h binary, m binary")
        .groupBy("b").applyInArrow(answer, "g bigint, b bigint, m binary")
    )
    kinds = dict(zip([key, *carry, text], [docs.schema[c].dataType.simpleString() for c in (key, *carry, text)], strict=True))
    inner = ", ".join([f"k {kinds[key]}", *[f"{n} {kinds[c]}" for c, n in zip(carry, names, strict=True)], f"x {kinds[text]}"])
    schema = f"{inner}, n_words bigint, n_removed bigint, kept_text string, removed array<struct<start:int,end:int>>"
    _spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    _empty = to_arrow_schema(StructType.fromDDL(schema)).empty_table()
    done = dealt.groupBy("g").cogroup(masks.groupBy("g")).applyInArrow(drop, schema)
    return done.select(
        F.col("k").alias(key), *[F.col(n).alias(c) for c, n in zip(carry, names, strict=True)], F.col("x").alias(text), "n_words", "n_removed", "kept_text", "removed"
    )
