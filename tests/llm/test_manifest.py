import hashlib

import pytest
from pyspark.sql import functions as F

from medallion.llm import merkle

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _levels(digests):
    """All levels of a tree, leaves first."""
    out = [digests]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def _siblings(levels, at):
    """Digests left and right of a node and its ancestors."""
    out = []
    for level in levels[:-1]:
        run = at // 8 * 8
        out.append(("".join(level[run:at]), "".join(level[at + 1 : run + 8])))
        at //= 8
    return out


def _plain(rows):
    """Leaf, subroot, root and proof of every row, by the definition."""
    first = lambda v: (v is not None, v)
    leaves = [(first(None if r["lang"] is None else r["lang"].encode()), first(r["doc_id"]), _h(*(_field(r[c]) for c in COLUMNS)), r["doc_id"], r["lang"]) for r in rows]
    groups = {}
    for leaf in sorted(leaves, key=lambda x: x[:3]):
        groups.setdefault(leaf[0], []).append(leaf)
    trees = [_levels([x[2] for x in g]) for g in groups.values()]
    top = _levels([t[-1][0] for t in trees])
    out = []
    for g, (members, tree) in enumerate(zip(groups.values(), trees, strict=True)):
        for at, (_, _, leaf, doc_id, lang) in enumerate(members):
            proof = _siblings(tree, at) + _siblings(top, g)
            out.append((doc_id, lang, at, leaf, proof, tree[-1][0], top[-1][0]))
    return sorted(out, key=repr)


def _found(df):
    hexed = lambda s: [(bytes(x["before"]).hex(), bytes(x["after"]).hex()) for x in s]
    return sorted(((r["doc_id"], r["lang"], r["position"], r["leaf"], hexed(r["siblings"]), r["subroot"], r["root"]) for r in df.collect()), key=repr)


@pytest.fixture
def forest(spark):
    """Groups of 1, 7, 8, 9, 64, 65 and 600 leaves, a null group, repeated rows, a row id that many share."""
    sizes = {"a": 1, "b": 7, "c": 8, "d": 9, "é": 64, "z": 65, "en": 600, None: 3, "": 2}
    rows = [(i if g != "d" else 4, f"text {i} É" if i % 5 else None, g, "s", i * 3, "x") for g, n in sizes.items() for i in range(n)]
    rows += [(1, "same", "b", None, None, "x")] * 20 + [(None, "no id", "b", "s", 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, leaf string")


def test_manifest_equals_plain_trees(forest):
    assert _found(merkle.manifest(forest, COLUMNS)) == _plain(forest.collect())


def test_many_groups(spark):
    rows = [(i, f"t{i}", f"g{i % 77:03}", "s", 1) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert _found(merkle.manifest(df, COLUMNS)) == _plain(df.collect())


def test_joins_without_broadcast(forest, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", 0)
    assert _found(merkle.manifest(forest, COLUMNS)) == _plain(forest.collect())


def test_proofs_fold_to_the_root_and_tampering_shows(forest):
    altered = F.sha2(F.lit("other"), 256)
    rows = merkle.manifest(forest, COLUMNS, keep={"altered": altered})
    checked = rows.select(
        (merkle.folded(F.col("leaf"), F.col("siblings")) == F.col("root")).alias("good"),
        (merkle.folded(F.col("altered"), F.col("siblings")) == F.col("root")).alias("bad"),
        merkle.proof_digest(F.col("siblings")).alias("proof"),
        "siblings",
    ).collect()
    assert all(r["good"] and not r["bad"] for r in checked)
    assert all(r["proof"] == _h(*(bytes(s[k]).hex() for s in r["siblings"] for k in ("before", "after"))) for r in checked)


def test_edges(edge_docs, empty):
    rows = merkle.manifest(edge_docs, COLUMNS)
    assert _found(rows) == _plain(edge_docs.collect())
    none = merkle.manifest(empty(edge_docs), COLUMNS)
    assert none.columns == rows.columns and none.count() == 0
    one = merkle.manifest(edge_docs.filter("doc_id = 6"), COLUMNS).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["siblings"] == []


def test_numbering_spreads_a_repeated_key(spark):
    df = spark.range(0, 4000, 1, 8).select(F.lit(5).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows, total = merkle.numbered(df, [F.col("k")], "test")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert total == 4000 and sorted(r["place"] for r in rows.select("place").collect()) == list(range(4000))
    assert len(rows.inputFiles()) > 1


def test_levels_are_dealt_over_as_many_tasks_as_their_nodes_need(spark, monkeypatch):
    """However many shuffle partitions there are: every file that a task writes costs a process on file systems without native code."""
    files = {}
    write = merkle.stored

    def counted(df, label):
        table = write(df, label)
        files[label] = len(table.inputFiles())
        return table

    monkeypatch.setattr(merkle, "stored", counted)
    monkeypatch.setattr(merkle, "NODES_A_TASK", 1000)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = [(i, f"t{i}", f"g{i % 3}", "s", 1) for i in range(3000)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        assert _found(merkle.manifest(df, COLUMNS)) == _plain(df.collect())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert files["merkle-leaves"] > 3 and [files[f"merkle-level-{k}"] for k in range(4)] == [3, 1, 1, 1]
