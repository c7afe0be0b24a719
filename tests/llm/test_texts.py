import random
import re
from datetime import date

import pyarrow as pa
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from medallion.llm import decontaminate, pii, toxicity
from medallion.llm.queries import PSEUDONYM_KEY
from medallion.llm.tables import load

BY_FORM = [
    (r"a.B@c.d.org, x", r"user-[0-9a-f]{12}@host-[0-9a-f]{8}\.example, x"),
    ("4111111111111111!", r"(?!4111111111111111)[0-9]{16}!"),
    ("4111 1111 1111 1111", r"[0-9]{4}( [0-9]{4}){3}"),
    ('token = "11acdfb36bb72224148e6160f674b4be45601bff"', r'token = "[0-9a-f]{40}"'),
    ("+1 (743) 555-3824", r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"),
    ("+49 30 123456", r"\+49 [0-9]{2} [0-9]{6}"),
    ("10.0.0.1", r"([0-9]{1,3}\.){3}[0-9]{1,3}"),
    ("2024-02-29", r"[0-9]{4}-[0-9]{2}-[0-9]{2}"),
    ("3/14/2020", r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"),
    ("123-45-6789", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
]
UNTOUCHED = ["4111111111111112", "999.1.1.1", "1.2.3.4.5", "2023-02-29", "666-45-6789", "000-12-1234", "plain text", "", "a@b", "12 34", "1234567"]


def masked(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [(r.text, r.n_replaced) for r in pii.mask_text(df, "k").orderBy("doc_id").collect()]


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, digits[::-1]))) % 10 == 0


def test_forms(spark):
    got = masked(spark, [t for t, _ in BY_FORM])
    for (text, form), (new, n) in zip(BY_FORM, got):
        assert n == 1 and new != text and re.fullmatch(form, new), (text, new)
    card, spaced = got[1][0].rstrip("!"), got[2][0].replace(" ", "")
    assert card == spaced and luhn(card)
    date.fromisoformat(got[7][0])
    assert masked(spark, UNTOUCHED) == [(t, 0) for t in UNTOUCHED]
    again = masked(spark, ["743-555-3824 / 1-743-555-3824 / +1 (743) 555-3824", "4465758382889437 4465758382889437"])
    assert len({d[-10:] for d in (re.sub("[^0-9]", "", p) for p in again[0][0].split(" / "))}) == 1
    assert len(set(again[1][0].split())) == 1


def test_networks_are_permutations(spark):
    for high, low in ((189, 773), (1000, 100), (7, 1), (1, 1)):
        ids = spark.range(high * low).select(pii.permute(F.col("id"), F.lit(high), F.lit(low), "k", "x").alias("p"))
        assert ids.agg(F.countDistinct("p"), F.min("p"), F.max("p")).first()[:] == (high * low, 0, high * low - 1)


def test_masking_is_all_that_changes(spark):
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    both = pii.mask_text(docs, PSEUDONYM_KEY).select("doc_id", F.col("text").alias("new"), "n_chars", "n_replaced").join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(both) == docs.count() and sum(r.n_replaced for r in both) > 0
    kinds = [re.compile(p.replace("++", "+")) for p in (pii.EMAIL, pii.HEX, pii.IP)]
    for r in both:
        assert r.n_chars == len(r.new)
        if r.n_replaced == 0:
            assert r.new == r.text
        for kind in kinds:
            for found in kind.findall(r.text):
                octets = found.split(".")
                if "@" in found or len(octets) != 4 or all(int(o) < 256 for o in octets):
                    assert found not in r.new
        for card in re.findall(r"(?<![0-9])[0-9]{16}(?![0-9])", r.text):
            assert (card in r.new) != luhn(card)


def test_masking_edges(edge_docs, empty):
    clash = edge_docs.withColumn("n_replaced", F.lit("old"))
    out = pii.mask_text(clash, "k")
    assert out.columns == [*edge_docs.columns, "n_replaced"] and out.count() == edge_docs.count()
    assert pii.mask_text(clash, "k", counted=None).columns == clash.columns
    assert pii.mask_text(empty(edge_docs), "k").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_pseudonym_is_worked_out_once(spark):
    """Of a card, a phone, an address or a date the network runs once, not once for each digit or part that is written."""
    per_kind = {"email": 2, "secret": 2}
    for kind, replace in pii._REPLACE.items():
        plan = spark.range(1).select(replace(F.col("id").cast("string"), "k").alias("p"))._jdf.queryExecution().analyzed().toString()
        assert plan.count("sha2(") <= per_kind.get(kind, 1), (kind, plan.count("sha2("))


def test_short_search_finds_what_all_kinds_find(spark):
    rng = random.Random(9)
    parts = [
        *"aBZféſK_%+-.@/ \n()=:\"'019|", "666", "token", "PassWord", "api_key", "AKIA", "ABCDEF0123456789", "deadbeef" * 4, "4111111111111111",
        "3782 822463 10005", "10.0.0.1", "256.1.1.1", "2024-02-29", "3/14/2020", "14.3.2020", "123-45-6789", "+1 (743) 555-3824",
        "743-555-3824", "+49 30 123456", "a.b@c.de", "token='abcdefgh1234'", "SECRET: \"HUNTER22HUNTER\"",
    ]
    texts = spark.createDataFrame([("".join(rng.choices(parts, k=rng.randrange(14))),) for _ in range(8000)], "text string")
    found = texts.select("text", *[F.regexp_extract_all("text", F.lit(f"({p})"), F.lit(1)).alias(x) for p, x in ((pii.ANY, "all"), (pii.SEARCHED, "short"))])
    assert found.filter("`all` <> short").take(1) == [] and found.filter("size(`all`) > 0").count() > 4000


def distance(a, b):
    """Least edits of ``a`` against any part of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a):
        step = [i + 1]
        for j, y in enumerate(b):
            step.append(min(row[j] + (x != y), row[j + 1] + 1, step[j] + 1))
        row = step
    return min(row)


def test_leaks_against_edit_distance(spark):
    rng = random.Random(4)
    items = load(spark, "/root/testdata/sf0.01", "benchmark").orderBy("item_id").collect()
    hosts = [r.text.split() for r in load(spark, "/root/testdata/sf0.01", "documents").filter("n_chars between 300 and 1500 and lang = 'en'").orderBy("doc_id").limit(60).collect()]
    vocabulary = [w for h in hosts for w in h]
    docs, planted = [], set()
    for k in range(300):
        item = rng.choice(items)
        words = re.findall(r"[\w']+", item.text)
        allowed = int(decontaminate.allowed_edits(len(words)))
        for _ in range(rng.randrange(0, allowed + 4)):
            at = rng.randrange(len(words))
            turn = rng.random()
            if turn < 0.4:
                words[at] = rng.choice(vocabulary)
            elif turn < 0.7:
                del words[at]
            else:
                words.insert(at, rng.choice(vocabulary))
        host = hosts[k % len(hosts)]
        cut = rng.randrange(len(host) + 1)
        docs.append((k, " ".join([*host[:cut], *words, *host[cut:]])))
        planted.add((k, item.item_id))
    texts = {k: [w.lower() for w in re.findall(r"[\w']+", t)] for k, t in docs}
    by_item = {i.item_id: [w.lower() for w in re.findall(r"[\w']+", i.text)] for i in items}
    limit = {i: int(decontaminate.allowed_edits(len(w))) for i, w in by_item.items()}
    want = {(k, i): d for k, i in planted if (d := distance(by_item[i], texts[k])) <= limit[i]}
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), load(spark, "/root/testdata/sf0.01", "benchmark"))
    got = {(r.doc_id, r.item_id): r.distance for r in found.collect()}
    assert len(want.keys() & got.keys()) >= 0.98 * len(want)
    assert all(got[k] == d for k, d in want.items() if k in got)
    assert not (planted - want.keys()) & got.keys()


def altered(rng, words, edits):
    """``words`` after that many edits, with fresh words."""
    words = list(words)
    for k in range(edits):
        at, turn = rng.randrange(len(words)), rng.random()
        if turn < 0.4:
            words[at] = f"new{k}"
        elif turn < 0.7:
            del words[at]
        else:
            words.insert(at, f"new{k}")
    return words


def test_leaks_of_any_length(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    items = [(n * 100 + k, rng.choices(vocabulary, weights, k=n)) for n in (3, 6, 15, 60, 200, 400, 1000) for k in range(6)]
    docs, planted = [], []
    for item_id, words in items:
        most = int(decontaminate.allowed_edits(len(words)))
        for edits in {0, most // 2, most}:
            host, cut = rng.choices(vocabulary, weights, k=300), rng.randrange(300)
            planted.append((len(docs), item_id))
            docs.append((len(docs), " ".join([*host[:cut], *altered(rng, words, edits), *host[cut:]])))
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), frame).collect()}
    assert set(planted) <= got
    # All pairs of the shorter items, by edit distance.
    texts = {i: t.split() for i, t in docs}
    short = [(i, w) for i, w in items if len(w) <= 15]
    want = {(d, i) for i, w in short for d, t in texts.items() if distance(w, t) <= int(decontaminate.allowed_edits(len(w)))}
    assert want == {(d, i) for d, i in got if i in {x for x, _ in short}}


@pytest.mark.parametrize("length", [6, 15, 40, 60])
def test_walks_meet_edited_parts(length):
    """Random edited copies, other texts than those that the number of walks was measured on."""
    edits = int(decontaminate.allowed_edits(length))
    walks = decontaminate.walks_needed(length, length, edits)
    rng = random.Random(length)
    met = 0
    for _ in range(300):
        words = [rng.randrange(1, 1 << 62) for _ in range(length)]
        copy = [w if isinstance(w, int) else rng.randrange(1, 1 << 62) for w in altered(rng, words, edits)]
        rows = np.array([*words, *copy], np.uint64)
        bounds = np.array([0, length]), np.array([length, len(rows)])
        a, b = decontaminate.walk_keys(rows, *bounds, length, walks)
        met += (a == b).any()
    assert met >= 0.99 * 300
    assert decontaminate.walks_needed(length, length, 0) == 1 and walks > 1


def test_equal_windows_share_every_key():
    rows = np.arange(1, 31, dtype=np.uint64).repeat(1)
    twice = np.concatenate([rows, rows])
    a, b = decontaminate.walk_keys(twice, np.array([0, 30]), np.array([30, 60]), 30, 3)
    assert (a == b).all() and a.shape == (3 * decontaminate.SAMPLES,)


def test_leaks_in_scripts_without_blanks(spark):
    zh, ja, th = "北京是中华人民共和国的首都，也是全国的政治中心。", "東京は日本の首都です。人口は約千四百万人。", "กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทย"
    items = [(1, zh), (2, ja), (3, th), (4, "what is “the capital city” of France — Paris"), (5, "Golden Gate"), (6, "golden  gate!"), (7, "水门")]
    docs = [
        (1, f"众所周知{zh}这一点没有疑问"), (2, f"実は{ja[:8]}{ja[9:]}とのこと"), (3, f"ว่า{th}และ"),
        (4, "He asked:what is the capital city of france…Paris"), (5, "The golden-gate bridge, golden gate"), (6, "golden\nhen gate"),
        (7, "北京是一个城市，首都在这里，政治很重要"), (8, "大水门桥"), (9, "golden"), (10, "gate"), (11, zh.replace("首都", "城市").replace("全国", "我国")),
    ]
    frames = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.distance, r.item_words, r.end) for r in decontaminate.find_leaks(*frames).collect()}
    assert {k: v[0] for k, v in got.items()} == {(1, 1): 0, (2, 2): 1, (3, 3): 0, (4, 4): 0, (5, 5): 0, (5, 6): 0, (8, 7): 0, (11, 1): 3}
    assert got[5, 5] == (0, 2, 15) and got[8, 7] == (0, 2, 9)
    assert decontaminate.drop_leaks(*frames).count() == 4


def test_leak_edges(spark, edge_docs, empty):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta"), (2, None), (3, ""), (None, "x y z"), (4, "one"), (5, "no id here at all")], "item_id long, text string")
    got = sorted((r.doc_id or -1, r.item_id) for r in decontaminate.find_leaks(edge_docs, items).collect())
    assert got == [(-1, 5), (4, 1), (4, 1), (5, 1)]
    kept = decontaminate.drop_leaks(edge_docs, items)
    assert kept.columns == edge_docs.columns and {r.doc_id for r in kept.collect()} == {0, 1, 2, 3, 6, 7, 8, 9}
    assert decontaminate.find_leaks(edge_docs, empty(items)).count() == 0
    assert decontaminate.find_leaks(empty(edge_docs), items).count() == 0
    pattern, region = pa.array([1, 2, 3]).to_numpy()[None], pa.array([9, 1, 2, 3, 9]).to_numpy()[None]
    assert [int(x[0]) for x in decontaminate.infix_distance(pattern, pa.array([3]).to_numpy(), region)] == [0, 4]


@pytest.fixture(scope="module")
def stages(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = load(spark, sf_dir, "documents")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "stage")
        seen.append(docs)
    return seen


def test_pipeline_stages(spark, stages):
    for before, after in zip(stages, stages[1:]):
        assert after.columns == before.columns and 0 < after.count() <= before.count()
    toxic = toxicity.score_toxicity(stages[0], toxicity.fit(stages[0], load(spark, "/root/testdata/sf0.001", "labels"))).filter("score >= 0.5")
    assert stages[0].count() - stages[1].count() == toxic.count()
    assert decontaminate.find_leaks(stages[3], load(spark, "/root/testdata/sf0.001", "benchmark")).count() == 0
    assert stages[4].count() == stages[3].count()


def test_pipeline_run(spark, stages):
    pieces = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in stages[4].select("doc_id").collect()}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_edges(spark, edge_docs, empty, name, stage):
    sf_dir = "/root/testdata/sf0.001"
    out = stage(spark, edge_docs, sf_dir)
    assert out.count() > 0
    if name != "packing":
        assert out.columns == edge_docs.columns
    assert stage(spark, empty(edge_docs), sf_dir).count() == 0
