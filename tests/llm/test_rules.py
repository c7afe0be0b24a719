import math
import random
import re
from fractions import Fraction

import pytest

from medallion.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def test_statistics_equal_plain_ones(spark):
    rnd = random.Random(5)
    vocabulary = ["a", "A", "é漢", "b#", "|", "$$$", " ", " x", "c"]
    texts = ["", None, " \n\n ", "a\na\r\na\n a", "x " * 7, "x " * 8, "x " * 9, "\n", "a\n"]
    texts += ["".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", "\n", "\t", "\r\n", "\x0b", "  "]) for _ in range(rnd.randrange(60))) for _ in range(80)]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    for row in rules.text_statistics(df).collect():
        assert {s: row[s] for s in rules.STATISTICS} == _plain(texts[row["id"]]), texts[row["id"]]


@pytest.mark.parametrize("n, p", [(1, 0.3), (40, 0.02), (300, 0.02), (300, 0.5)])
def test_binomial_equals_exact_sums(n, p):
    share, total = Fraction(p), Fraction(0)
    for k in range(n + 1):
        total += math.comb(n, k) * share**k * (1 - share) ** (n - k)
        assert rules.binomial_cdf(k, n, p) == pytest.approx(float(total), rel=1e-9)
    assert rules.binomial_cdf(-1, n, p) == 0


def _corpus(spark, n, seed, noisy=0.0):
    """Two strata; bad documents are full of symbols, and so is a share of the good ones of stratum ``b``."""
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        stratum, good = "ab"[i % 2], rnd.random() < 0.7
        marked = not good or (stratum == "b" and rnd.random() < noisy)
        words = [rnd.choice(["ab", "cde", "fghi", "jk"]) + str(rnd.randrange(9999)) + ("#*" if marked else "") for _ in range(40)]
        docs.append((i, " ".join(words), stratum))
        labels.append((i, int(good), 0))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_cutoffs_hold_their_risk_by_stratum(spark):
    docs, labels = _corpus(spark, 2500, 1, noisy=0.3)
    rows = rules.keep_good(docs, labels).join(labels, rules.F.col("id") == labels["doc_id"]).collect()
    lost = {s: [not r["kept"] for r in rows if r["stratum"] == s and r["quality"] == 1] for s in "ab"}
    caught = {s: [not r["kept"] for r in rows if r["stratum"] == s and r["quality"] == 0] for s in "ab"}
    assert sum(caught["a"]) == len(caught["a"]) and sum(lost["a"]) <= rules.RISK * len(lost["a"])
    # Stratum b cannot reject symbols without losing far more than the risk of its good documents.
    assert sum(caught["b"]) == 0 and sum(lost["b"]) <= rules.RISK * len(lost["b"])


def test_few_labels_certify_nothing(spark):
    docs, labels = _corpus(spark, 120, 2)
    strata = rules.cutoffs(rules.labelled_rows(rules.text_statistics(docs), labels)).collect()
    assert {r["stratum"] for r in strata} == {"a", "b"} and all(r["cutoff"] is None for r in strata)


def test_certified_cutoff_by_hand(spark):
    """The least suspicion whose lost good documents of the holdout pass the exact test."""
    docs, labels = _corpus(spark, 2500, 3, noisy=0.01)
    labelled = rules.labelled_rows(rules.text_statistics(docs), labels)
    purity = {(r["stratum"], r["rule"], r["bin"]): r["purity"] for r in rules.purities(labelled).collect()}
    rows = labelled.collect()
    names = list(rules.rule_bins())
    for found in rules.cutoffs(labelled).collect():
        s = found["stratum"]
        fit = [r for r in rows if r["fitting"] and r["stratum"] == s]
        for i, name in enumerate(names):
            best = 0
            for b in range(rules.BINS + 1):
                beyond = [r["good"] for r in fit if r[name] >= b]
                best = max(best, (2 * beyond.count(False) + 1) / (2 * len(beyond) + 2))
                assert purity[s, i, b] == best
        doubt = lambda r: max(purity[r["stratum"], i, r[n]] for i, n in enumerate(names))
        holdout = [doubt(r) for r in rows if not r["fitting"] and r["good"] and r["stratum"] == s]
        values = sorted({v for (t, _, _), v in purity.items() if t == s and v > rules.LEAST_PURITY})
        sure = [v for v in values if rules.binomial_cdf(sum(h >= v for h in holdout), len(holdout), rules.RISK) <= rules.ERROR / 2]
        assert found["cutoff"] == (sure[0] if sure else None)


def test_edges(edge_docs, labels, empty):
    rows = rules.keep_good(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r["id"]: r for r in rows}
    for i in (0, 1, 2):
        assert by_id[i]["n_words"] == 0 and by_id[i]["base_failed"] and not by_id[i]["kept"]
    assert by_id[6]["n_words"] == 60_000 == by_id[6]["n_repeat_words"] and by_id[7]["word_chars"] == 150_000
    assert len({tuple(r) for r in rows if r["id"] == 4}) == 1
    assert rules.keep_good(empty(edge_docs), labels).count() == 0
    assert rules.keep_good(edge_docs, empty(labels)).count() == edge_docs.count()
    null_stratum = edge_docs.withColumn("lang", rules.F.lit(None).cast("string"))
    assert rules.keep_good(null_stratum, labels).count() == edge_docs.count()
