"""URL filter: explicit rules, and a path-template tree for urls that no rule names.

Per host, variable path segments become wildcards: by their form (numbers, hex, mixed ids) and, where a node
of the tree has many different children, by statistics. Nodes below a wildcard are those of the generalised
path, so what varies there becomes a wildcard too, to any depth. Urls with a rule are the labelled ones. Templates of
a host and depth whose labelled share does not differ significantly are merged; a template is rejected
when its smoothed share of blocked urls is high.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.tables import stored

ALLOW, BLOCK = "allow", "block"
Rule = tuple[str, str, str]  # host, path, verdict

#: A node with so many different children has a variable there.
WIDE = 20
#: Weight of the overall share of blocked urls, in urls, against a template's own.
SMOOTHING = 4.0
#: Standard errors from the pooled share at which a branch is kept apart.
DIFFERENT = 1.96
REJECT = 0.7

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for urls without ``://``."""
    found = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(found > 0, url.substr(found + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return _lower(host), path


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule (host and path joined) that fits: its text and verdict, or null."""
    ordered = sorted(rules, key=lambda r: len(r[0] + r[1]), reverse=True)
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in reversed(ordered):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def shapes(path: Column) -> Column:
    """Path segments with numbers, hex strings and other mixed ids replaced by their form."""

    def shape(segment: Column) -> Column:
        forms = [
            (r"^[0-9]+$", "<n>"),
            (r"^[0-9]+\.([a-z0-9]{1,5})$", r"<n>.$1"),
            (r"^[0-9a-f-]{8,}$", "<hex>"),
            (r"^.*[0-9].*[0-9].*[0-9].*$", "<id>"),
        ]
        return reduce(lambda s, f: F.regexp_replace(s, *f), forms, segment)

    segments = F.filter(F.split(_lower(path), "/"), lambda s: s != "")
    return F.transform(segments, shape)


#: Cells that a task hands on at a time.
CELLS = 100_000


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment with its level and the node above it: a hash of the host and the generalised segments before."""
    names = ["path", "level", "node", "segment"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.string()]
    held: list[tuple] = []

    def report() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), types)], names=names)

    for batch in batches:
        for path, host, segments, wild in zip(*(batch.column(c) for c in ("path", "host", "shape", "wild"))):
            path, wild = path.as_py(), set(wild.as_py() or ())
            node = blake2b(host.as_py().encode(), digest_size=8).digest()
            for level, segment in enumerate(segments.as_py()):
                held.append((path, level, int.from_bytes(node, "little", signed=True), segment))
                # A wildcard differs from every segment, which holds no slash.
                step = "/" if level in wild else segment
                node = blake2b(node + step.encode(), digest_size=8).digest()
                if len(held) >= CELLS:
                    yield report()
                    held = []
    if held:
        yield report()


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Template of each path."""
    for batch in batches:
        found = []
        for segments, wild in zip(batch.column("shape"), batch.column("wild")):
            wild = set(wild.as_py() or ())
            found.append("/" + "/".join("*" if level in wild else s for level, s in enumerate(segments.as_py())))
        yield batch.drop_columns(["path", "wild"]).append_column("template", pa.array(found, pa.string()))


def wild_levels(paths: DataFrame) -> DataFrame:
    """``path, wild``: levels of each path (path, host, shape) that lie below a node with WIDE or more different children.

    Children count below the generalised path: each round merges the nodes that the wildcards found so far make equal.
    A node keeps all children it had, so wildcards only come on, and the rounds end when none does: after one
    more than there are wildcards below each other.
    """
    wild = paths.select("path", F.lit(None).cast("array<int>").alias("wild")).limit(0)
    known = 0
    while True:
        cells = paths.join(wild, "path", "left").select("path", "host", "shape", "wild").mapInArrow(
            _cells, "path long, level int, node long, segment string"
        )
        children = cells.groupBy("node", "segment").agg(F.lit(1).alias("one")).groupBy("node").agg(F.count("*").alias("children"))
        wide = stored(children.filter(F.col("children") >= WIDE).select("node"), "wide")
        # One row per path, which holds no more levels than the path has.
        wild = stored(cells.join(wide, "node", "left_semi").groupBy("path").agg(F.collect_set("level").alias("wild")), "wild")
        now = wild.agg(F.coalesce(F.sum(F.size("wild")), F.lit(0))).first()[0]
        if now == known:
            return wild
        known = now


def templates(urls: DataFrame) -> DataFrame:
    """Template of every distinct (host, shape) with its urls (``n``), ``labelled`` and ``blocked`` ones."""
    flat = urls.groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.count("label").alias("labelled"), F.count(F.when(F.col("label") == BLOCK, 1)).alias("blocked")
    )
    flat = stored(flat.withColumn("path", F.xxhash64("host", F.to_json("shape"))), "paths")
    named = flat.join(wild_levels(flat.select("path", "host", "shape")), "path", "left")
    columns = "host string, shape array<string>, n long, labelled long, blocked long"
    return named.select("path", "host", "shape", "n", "labelled", "blocked", "wild").mapInArrow(_named, columns + ", template string")


def rejected_templates(table: DataFrame) -> DataFrame:
    """``table`` (see ``templates``) with ``branch``, ``purity`` and ``rejected``.

    Branches of a host with equally many segments are compared with their pooled share of blocked urls; those
    that do not differ significantly are merged, as are all higher and all lower ones. The merged share is smoothed
    towards the share over all labelled urls.
    """
    leaf = ["host", "depth", "template"]
    table = table.withColumn("depth", F.size("shape"))
    branches = table.groupBy(*leaf).agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    pools = branches.groupBy("host", "depth").agg(F.sum("l").alias("pool_l"), F.sum("b").alias("pool_b"))
    share = F.col("pool_b") / F.greatest("pool_l", F.lit(1))
    error = F.sqrt(share * (1 - share) / F.greatest("l", F.lit(1)))
    gap = F.col("b") / F.greatest("l", F.lit(1)) - share
    side = F.when((F.col("l") > 0) & (error > 0) & (F.abs(gap) > DIFFERENT * error), F.signum(gap).cast("int")).otherwise(0)
    sided = branches.join(pools, ["host", "depth"]).select(*leaf, "l", "b", side.alias("branch"))
    merged = sided.groupBy("host", "depth", "branch").agg(F.sum("l").alias("ml"), F.sum("b").alias("mb"))
    overall = table.agg((F.sum("blocked") / F.greatest(F.sum("labelled"), F.lit(1))).alias("overall"))
    prior = F.coalesce(overall.scalar(), F.lit(0.0))
    purity = (F.col("mb") + SMOOTHING * prior) / (F.col("ml") + SMOOTHING)
    judged = sided.join(merged, ["host", "depth", "branch"]).select(*leaf, "branch", purity.alias("purity"))
    return table.join(judged, leaf).withColumn("rejected", F.col("purity") >= REJECT)


def judge_urls(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` for every row of ``pages``.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest wins. Without a rule
    the template decides. A null url or one without ``://`` has empty host and path, and the template
    ``/``. Whole paths of any depth are told apart. Repeated rows count as often as they occur; an empty table gives no
    row; other columns are ignored.
    """
    host, path = split_url(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "found", rule_of(F.col("host"), F.col("path"), rules)
    )
    urls = urls.select("page_id", "host", "path", "found.rule", F.col("found.verdict").alias("label"), shapes(F.col("path")).alias("shape"))
    judged = rejected_templates(templates(urls)).select("host", "shape", "template", "purity", "rejected")
    verdict = F.coalesce("label", F.when(F.col("rejected"), BLOCK).otherwise(ALLOW))
    return urls.join(judged, ["host", "shape"], "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity"
    )
