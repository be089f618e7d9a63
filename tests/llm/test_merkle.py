"""Merkle manifests against trees hashed one node at a time."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle
from millrace.llm.arrow import SCHEMAS
from millrace.llm.queries import QUERIES
from millrace.session import scratch_path
from oracle import mismatch

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def hashed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[c] for c in COLUMNS)]
    return hashed(*fields)


def tree(leaves):
    """The root, and a list of (left, sibling or None) for each leaf."""
    paths, level, place = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for path, at in zip(paths, place, strict=True):
            other = at ^ 1
            path.append((at % 2 == 1, level[other] if other < len(level) else None))
        level = [hashed(*level[k : k + 2]) for k in range(0, len(level), 2)]
        place = [at // 2 for at in place]
    return level[0], paths


def fold(node, path):
    for left, other in path:
        node = hashed(other or "", node) if left else hashed(node, other or "")
    return node


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    own = {}
    for name in names:
        ordered = sorted(
            groups[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r))
        )
        own[name] = ordered, *tree([leaf_of(r) for r in ordered])
    root, tops = tree([own[name][1] for name in names]) if names else (None, [])
    out = []
    for name, top in zip(names, tops, strict=True):
        ordered, subroot, paths = own[name]
        for row, path in zip(ordered, paths, strict=True):
            steps, leaf = path + top, leaf_of(row)
            doc, compared = row["doc_id"], dict(row)
            if doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and row["n_chars"] is not None:
                compared["n_chars"] += 1
            proof = hashed(*[other for _, other in steps if other])
            folded = fold(leaf_of(compared), steps)
            out.append((doc, leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def documents(n):
    rows = [
        {"doc_id": k, "text": f"text {k} é", "lang": ("en", "de", "é", None)[(k % 7) % 4],
         "source": None if k % 5 == 0 else "s", "n_chars": None if k % 3 == 0 else k}
        for k in range(n)
    ]
    rows += [{"doc_id": 3, "text": "another text of a known id", "lang": "en", "source": "", "n_chars": 0}] * 2
    rows += [{"doc_id": None, "text": None, "lang": "en", "source": "-", "n_chars": 2**63 - 1}] * 2
    rows += [{"doc_id": 70, "text": "", "lang": "", "source": None, "n_chars": 2**63 - 1}]
    rows += [{"doc_id": -1, "text": "long " * 100_000, "lang": "one", "source": "s", "n_chars": -5}]
    return rows


def stored(spark, rows):
    root = scratch_path(spark, "test-merkle")
    schema = SCHEMAS["documents"] + ", digest string, tree int"
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    data = [tuple({"digest": "x", "tree": 1, **row}[c] for c in names) for row in rows]
    spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{root}/documents.parquet")
    return root


@pytest.mark.parametrize("n", [0, 1, 700])
def test_query_equals_trees_hashed_node_by_node(spark, n):
    rows = documents(n)
    result = QUERIES["op13_merkle_manifest"].run(spark, stored(spark, rows))
    assert sorted(map(tuple, result.collect()), key=repr) == expected(rows)


def test_no_documents_no_rows(spark):
    assert QUERIES["op13_merkle_manifest"].run(spark, stored(spark, [])).collect() == []


def test_query_equals_sql(spark, small):
    query = QUERIES["op13_merkle_manifest"]
    assert mismatch(query.run(spark, small), small, query.sql) is None


@pytest.mark.parametrize("every", [1, 8])
@pytest.mark.parametrize("n", [2, 37])
def test_any_spacing_of_stored_levels_gives_the_same_proofs(spark, every, n):
    rows = [(f"={k % 2}", k, hashed(str(k))) for k in range(2 * n - 1)]
    leaves = spark.createDataFrame(rows, "tree string, k int, digest string")
    made = merkle.build(leaves, ["k"], every)
    roots = {r.tree: r.digest for r in made.roots.collect()}
    proofs = merkle.proofs(made, ["k"])
    ok = proofs.withColumn("root", merkle.folded(F.col("digest"), F.col("path"))).collect()
    for name in roots:
        own = [d for t, _, d in rows if t == name]
        root, paths = tree(own)
        assert roots[name] == root
        got = sorted((r for r in ok if r.tree == name), key=lambda r: r.k)
        assert [[tuple(s) for s in r.path] for r in got] == paths and {r.root for r in got} == {root}
    # Only the leaves and one level in ``every`` are stored.
    depth = (n - 1).bit_length()
    assert len(made.stored) == 1 + -(-depth // every)
    assert sum(level.count() for level in made.stored[1:]) <= len(rows) / 2**every * 2 + 2 * depth


def test_one_tree_with_all_rows_is_numbered_by_ranges(spark):
    digest = F.sha2(F.col("id").cast("string"), 256).alias("digest")
    rows = spark.range(5000).select(F.lit("=a").alias("tree"), (F.col("id") % 7).alias("k"), digest)
    placed = merkle.numbered(rows, ["k", "digest"])
    own = sorted((r.k, r.digest) for r in rows.collect())
    got = sorted((r.position, r.k, r.digest) for r in placed.collect())
    assert [g[0] for g in got] == list(range(5000)) and [g[1:] for g in got] == own
