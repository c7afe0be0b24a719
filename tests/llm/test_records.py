import base64
import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from medallion.llm import packing, tokens, urls, warc
from medallion.llm.queries import URL_RULES
from medallion.llm.tables import load
from medallion.llm.text import text_chunks

MAGIC = warc.MAGIC
PAGES = [
    (1, "http://a/", "x"), (2, "http://a/", "x"), (3, None, None), (4, "u\r\nv", ""), (5, "h", MAGIC),
    (6, "h", MAGIC + "WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + MAGIC + "q"), (7, "h", "a\r\n\r\n" + MAGIC + "é"),
    (8, "h", "y" * 70000 + MAGIC + "z" * 70000 + MAGIC), (9, "w", "x"), (10, "w", "tail\r\n\r\n"), (11, "w", MAGIC),
]


def expected(pages):
    best = {}
    for page, _, html in pages:
        best[html or ""] = max(best.get(html or "", page), page)
    out = set()
    for page, _, html in pages:
        raw, whole = (html or "").encode(), best[html or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.add((page, len(raw), digest, *(("response", None) if whole == page else ("revisit", whole))))
    return out


def records(df):
    return {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()}


@pytest.mark.parametrize("split", ["128m", "30k"])
def test_archive_round_trip(spark, split):
    pages = spark.createDataFrame([(*p, 7) for p in PAGES], "page_id long, url string, html string, block int")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for rows in (pages.coalesce(1), pages.repartition(3)):
            assert records(warc.round_trip(rows)) == expected(PAGES)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archive_jumps_follow_magics_not_records(spark, monkeypatch):
    """Records without the magic in their payload are one run, however many; a chain may enter a run behind its first piece."""
    asked = []
    jumps = warc.reachable
    monkeypatch.setattr(warc, "reachable", lambda edges: asked.append(edges.count()) or jumps(edges))
    plain = [(i, "h", f"page {i}") for i in range(600)]
    rows = spark.createDataFrame(plain, "page_id long, url string, html string").coalesce(1)
    assert records(warc.round_trip(rows)) == expected(plain)
    fake = f"{MAGIC}WARC-Type: response\r\nContent-Length: {{}}\r\n\r\nabc"
    # A record in a payload that ends with its host, one that claims too much, and one that ends inside the next page.
    odd = [(700, "h", "a" + fake.format(3)[:-3]), (701, "h", "b" + fake.format(3)), (702, "h", "c" + fake.format(90)), (703, "h", fake.format(7) + "d" + fake.format(0))]
    odd += [(800 + i, "h", "e" + fake.format(i) + fake.format(i * 37)) for i in range(40)]
    mixed = [page for pair in zip(plain, odd) for page in pair] + plain[len(odd) :]
    rows = spark.createDataFrame(mixed, "page_id long, url string, html string").coalesce(1)
    assert records(warc.round_trip(rows)) == expected(mixed)
    assert asked[0] <= 2 and asked[1] < 4 * len(odd)


def test_archive_smallest_size_and_ties(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (2, "u", "ab"), (None, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in warc.round_trip(pages, min_bytes=3).collect())
    assert kinds == [(0, "response", None), (1, "response", None), (2, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]
    kinds = sorted((r.page_id or 0, r.record_type) for r in warc.round_trip(pages).collect())
    assert kinds == [(0, "revisit"), (1, "revisit"), (2, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    path = rest[cut:]
    end = min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))
    return rest[:cut].translate(str.maketrans(urls._UPPER, urls._LOWER)), path[:end]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_urls_against_rules(spark):
    extra = [None, "", "x", "http://ORG", "http://a.org/", "a://u:1/x://y/", "http://B.Example.ORG/en/12?x", "http://example.com/fr/#a", "http://É.com/de/\n1", "h://" + "d/" * 30]
    pages = load(spark, "/root/testdata/sf0.01", "pages").select("page_id", "url")
    odd = spark.createDataFrame([(10**6 + i, u) for i, u in enumerate(extra)] + [(None, "http://x.net/1")], "page_id long, url string")
    rows = pages.unionByName(odd)
    url_of = {r.page_id: r.url for r in rows.collect()}
    got = urls.judge_urls(rows, URL_RULES).collect()
    assert len(got) == len(url_of)
    for r in got:
        host, path = split(url_of[r.page_id])
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert urls.judge_urls(rows.limit(0), URL_RULES).count() == 0


def test_templates_learn_from_labelled_urls(spark):
    """A host whose labelled urls are blocked loses its other urls of that form too; a clean host keeps them."""
    rules = (("bad.com", "/user/", "block"), ("good.com", "/user/", "allow"))
    rows = [(i, f"http://{h}.com/user/name{chr(97 + i % 26)}{chr(97 + i // 26)}") for i, h in enumerate(["bad", "good"] * 60)]
    rows += [(900 + i, f"http://{h}.com/list/{i}") for i, h in enumerate(["bad", "good"])]
    got = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert got[0].template == "/user/*" and got[900].verdict == "block" and got[901].verdict == "allow"


def plain_templates(paths):
    """Level by level: children of each generalised prefix, all of them wildcards where there are many."""
    done = {p: [] for p in paths}
    for level in range(max(map(len, paths))):
        children = {}
        for p in paths:
            if len(p) > level:
                children.setdefault(tuple(done[p]), set()).add(p[level])
        for p in paths:
            if len(p) > level:
                done[p] = done[p] + ["*" if len(children[tuple(done[p])]) >= urls.WIDE else p[level]]
    return {p: "/" + "/".join(t) for p, t in done.items()}


def test_wildcards_below_wildcards_and_whole_paths(spark):
    """Few children per raw prefix, many below the wildcard; and deep paths that differ in their last segments."""

    def name(i):
        return chr(97 + i // 26 % 26) + chr(97 + i % 26) + "x"

    paths = [("u", name(u), "post", name(60 + 3 * u + k), "end"[:k]) if k else ("u", name(u), "post", name(60 + 3 * u)) for u in range(60) for k in range(3)]
    paths += [("deep", *("d" * 12), kind, name(i)) for i in range(50) for kind in ("good", "bad")] + [("few", name(i)) for i in range(5)]
    paths += [tuple("s" * 3000), ()]
    rows = [(i, "http://h.com/" + "/".join(p)) for i, p in enumerate(paths)]
    rules = tuple(("h.com", f"/deep/{'d/' * 12}{kind}/{name(i)}", v) for kind, v in (("good", "allow"), ("bad", "block")) for i in range(40))
    got = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string").repartition(4), rules).collect()}
    want = plain_templates(paths)
    assert [got[i].template for i in range(len(paths))] == [want[p] for p in paths]
    assert {want[p] for p in paths if p[:1] == ("u",)} == {"/u/*/post/*", "/u/*/post/*/e", "/u/*/post/*/en"}
    unnamed = [(p, got[i]) for i, p in enumerate(paths) if p[:1] == ("deep",) and got[i].rule is None]
    assert len(unnamed) == 20 and all(r.verdict == ("allow" if "good" in p else "block") for p, r in unnamed)


def test_ids_equal_the_tokenizer():
    files = [public_tokenizers.path(n) for n in (tokens.VOCABULARY, tokens.RANKS)]
    whole, ours = Tokenizer.from_file(files[0]), tokens.PieceTokenizer(*files)
    rng = random.Random(1)
    parts = ["a", "b", "é", "'s", "'re", "'", "'ll", "'t", " ", "  ", "\n", "\t", "1", "2٣", ".", "!!", "\u00a0", "\u3000", "日本", "<|endoftext|>", "<|endof", "text|>", "|>", "<", "\r\n", "'d", "'S", "x", "\u200b", "z" * 60]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 14))) for _ in range(4000)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    for first, end, data, offsets in text_chunks(batch, size=5000):
        ids, at = ours.encode(data, offsets)
        for i in range(first, end):
            assert ids[at[i - first] : at[i - first + 1]].tolist() == whole.encode(texts[i], add_special_tokens=False).ids


def check_pieces(docs, pieces):
    whole = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    pieces = pieces.sort_values(["sequence_id", "offset"])
    by_sequence = pieces.groupby("sequence_id")
    assert ((by_sequence["length"].cumsum() - pieces["length"]) == pieces["offset"]).all()
    assert by_sequence["length"].sum().max() <= packing.SEQUENCE
    by_doc = {}
    for p in pieces.itertuples():
        by_doc.setdefault(p.doc_id, []).append(p)
    assert set(by_doc) == set(docs)
    for doc, text in docs.items():
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    return by_sequence["length"].sum()


def test_packing_round_trip(spark):
    docs = load(spark, "/root/testdata/sf0.001", "documents")
    fills = check_pieces({r.doc_id: r.text for r in docs.collect()}, packing.pack_documents(docs.repartition(3)).toPandas())
    assert fills.sum() / (len(fills) * packing.SEQUENCE) > 0.98


def test_packing_edges(edge_docs, empty):
    docs = edge_docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    check_pieces({r.doc_id: r.text for r in docs.collect()}, packing.pack_documents(docs).toPandas())
    twice = packing.pack_documents(edge_docs).filter("doc_id = 4 and start = 0")
    assert twice.count() == 2
    assert packing.pack_documents(empty(edge_docs)).count() == 0


def test_packer_keeps_few_windows_open():
    rng = np.random.default_rng(0)
    packer, open_now = packing.Packer(100, 4, 5), set()
    for n in rng.integers(1, 260, 500):
        parts, closed = packer.place(int(n))
        open_now |= {w for _, _, w, _ in parts}
        open_now -= set(closed)
        assert len(open_now) <= 4 and sum(p[1] for p in parts) == n


def test_tokenizing_holds_little_at_a_time():
    """Tables of characters and the work on a batch take a few tens of MB, whatever the batch holds."""
    rng = np.random.default_rng(2)
    words = [f"word{k}" for k in range(3000)]
    texts = [" ".join(rng.choice(words, 400)) for _ in range(2500)]
    batch = pa.RecordBatch.from_pydict({"_text": texts})
    files = [public_tokenizers.path(n) for n in (tokens.VOCABULARY, tokens.RANKS)]
    tracemalloc.start()
    tokens.character_classes()
    classes = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    rows = sum(part.num_rows for part, _, _ in tokens.tokenized(iter([batch]), "_text", *files))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts) and classes < 8 << 20 and most < 64 << 20
