import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from phenoloom.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """Root, and the siblings of every leaf level by level, built from the whole list at once."""
    proofs, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for k, p in enumerate(places):
            proofs[k].append([x for j, x in enumerate(runs[p // 8]) if j != p % 8])
        nodes, places = [h(*r) for r in runs], [p // 8 for p in places]
    return nodes[0] if nodes else None, proofs


def refold(node, place, proof):
    for others in proof:
        node = h(*others[: place % 8], node, *others[place % 8 :])
        place //= 8
    return node


def brute(rows, altered):
    """``rows``: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in langs:
        members = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = members, *tree([leaf(r) for r in members])
    root, above = tree([trees[g][1] for g in langs])
    out = []
    for i, g in enumerate(langs):
        members, subroot, proofs = trees[g]
        for place, (r, proof) in enumerate(zip(members, proofs)):
            flat = [x for level in [*proof, *above[i]] for x in level]
            folded = refold(refold(leaf(altered(r)), place, proof), i, above[i])
            out.append((r[0], leaf(r), subroot, root, flat, h(*flat), folded, folded == root))
    return sorted(out, key=repr)


def lowered(r):
    if r[0] is None or r[4] is None or zlib.crc32(str(r[0]).encode()) % 3:
        return r
    return (*r[:4], r[4].translate({c: c + 32 for c in range(65, 91)}))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def run(docs):
    fields = [F.col(c) for c in FIELDS[:4]]
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_digest(*fields, text))
    out = merkle.manifest(docs, "doc_id", "lang", merkle.leaf_digest(*fields, F.col("text")), altered)
    return sorted([tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof", "proof_sha256", "folded_root", "verified").collect()], key=repr)


def check(docs):
    want = brute([tuple(r) for r in docs.select(FIELDS).collect()], lowered)
    found = run(docs)
    assert len(found) == len(want)
    for a, b in zip(found, want):
        assert a == b


def test_documents(documents, odd_documents):
    check(documents.select(FIELDS))
    # rows equal in all fields may change places: their proofs are compared as a set, which sorting does
    check(odd_documents.select("*").unionByName(documents, allowMissingColumns=True))


@pytest.mark.parametrize("n, groups", [(1, 1), (8, 1), (9, 1), (64, 1), (65, 70), (511, 1), (513, 2), (4097, 1), (700, 9), (2000, 520)])
def test_shapes(spark, n, groups):
    docs = spark.range(n).select(
        (F.col("id") * 7).alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") % groups > 0, F.concat(F.lit("É~a-:*"), (F.col("id") % groups).cast("string"))).alias("lang"),
        F.col("id").alias("n_chars"), F.concat(F.lit("Text "), F.col("id")).alias("text"),
    )
    check(docs)


def test_one_group_holds_nearly_all_and_ties(spark):
    docs = spark.range(1500).select(
        F.when(F.col("id") > 3, F.floor(F.col("id") / 5)).alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") < 1400, "en").otherwise("de").alias("lang"),
        F.col("id").alias("n_chars"), F.lit("X").alias("text"),
    )
    check(docs)


def test_empty(documents):
    assert run(documents.limit(0)) == []


def test_octopus_asks_for_the_fewest_nodes():
    for leaves, held in [(1, [0]), (9, [0]), (9, [8]), (700, [0, 1, 2, 699]), (513, list(range(512))), (64, list(range(64))), (70, [3, 64])]:
        asked = merkle.missing(held, leaves)
        # a node is needed exactly if no held leaf lies below it and one lies below its parent
        want, level, width = [], 0, leaves
        while width > 1:
            below = {p // 8**level for p in held}
            want += [(level, p) for p in range(width) if p not in below and any(q // 8 == p // 8 for q in below)]
            level, width = level + 1, -(-width // 8)
        assert sorted(asked) == sorted(want) and len(set(asked)) == len(asked)
