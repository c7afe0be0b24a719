"""Reference SQL of the manifest, the certified rules and the vector codes, written without regard to speed."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc32(text: str) -> str:
    """Unsigned crc32 of ASCII text, bit by bit."""
    byte = f"list_transform(regexp_extract_all({text}, '.'), lambda ch: CAST(ascii(ch) AS BIGINT))"
    bits = "list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(4294967295, list_reduce(list_concat([4294967295], {byte}), lambda c, b: {bits}))"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    values = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return f"sha256({' || '.join(map(_field, values))})"


def _tree(name: str, source: str, levels: int = 12) -> str:
    """CTEs ``name_0`` ... over rows (tree, pos, digest): a level is the parents of the one before; single nodes stay."""
    parts = [f"{name}_0 AS ({source})"]
    for k in range(1, levels + 1):
        parts.append(f"""{name}_s{k} AS (
  SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}_{k - 1}
), {name}_{k} AS (
  SELECT tree, pos // 8 AS pos, CASE WHEN max(n) = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
  FROM {name}_s{k} GROUP BY tree, pos // 8
)""")
    return ", ".join(parts)


def _proof(name: str, levels: int = 12) -> tuple[str, str]:
    """Joins that find the siblings left and right of a node at each level of tree ``name``, and their texts in order."""
    joins, pairs = [], []
    for k in range(1, levels + 1):
        joins.append(f"LEFT JOIN {name}_r{k} {name}{k} ON {name}{k}.tree = {name}_tree AND {name}{k}.pos = {name}_pos // {8 ** (k - 1)}")
        pairs.append(f"[{name}{k}.before, {name}{k}.after]")
    return " ".join(joins), ", ".join(pairs)


def _runs(name: str, levels: int = 12) -> str:
    """Per node of a level with several nodes, what stands before and after it in its run."""
    parts = []
    for k in range(1, levels + 1):
        over = "OVER (PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN {})"
        before, after = over.format("UNBOUNDED PRECEDING AND 1 PRECEDING"), over.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")
        parts.append(f"""{name}_r{k} AS (
  SELECT tree, pos, coalesce(string_agg(digest, '') {before}, '') AS before, coalesce(string_agg(digest, '') {after}, '') AS after
  FROM {name}_s{k} WHERE n > 1
)""")
    return ", ".join(parts)


def manifest_sql() -> str:
    low_joins, low_pairs = _proof("low")
    top_joins, top_pairs = _proof("top")
    start = "SELECT dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, pos, leaf AS digest FROM leaves"
    return f"""
WITH leaves AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf,
    CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_leaf(_LOWER.format("text"))} END AS tampered,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, {_leaf("text")}) - 1 AS pos,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
  FROM documents
), {_tree("low", start)}, {_tree("top", "SELECT -1 AS tree, tree AS pos, digest FROM low_12")}, {_runs("low")}, {_runs("top")},
named AS (SELECT *, tree AS low_tree, pos AS low_pos, -1 AS top_tree, tree AS top_pos FROM leaves),
proofs AS (
  SELECT doc_id, leaf, tampered, named.tree AS tree, list_filter([{low_pairs}, {top_pairs}], lambda p: p[1] IS NOT NULL) AS proof
  FROM named {low_joins} {top_joins}
), folds AS (
  SELECT *, list_reduce(list_concat([[coalesce(tampered, leaf), '']], proof), lambda a, s: [sha256(s[1] || a[1] || s[2]), ''])[1] AS folded_root
  FROM proofs
)
SELECT f.doc_id, f.leaf, s.digest AS subroot, r.digest AS root,
  sha256(array_to_string(list_transform(proof, lambda p: p[1] || p[2]), '')) AS proof_sha256, folded_root, folded_root = r.digest AS verified
FROM folds f JOIN low_12 s ON s.tree = f.tree CROSS JOIN top_12 r
"""


def rules_sql() -> str:
    part = _crc32("CAST(b.id AS VARCHAR)") + " % 5"
    words = "regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')"
    lines = "list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]'))"
    # log of C(n, i) p^i (1 - p)^(n - i) with p = 0.02
    term = "exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.02) + (n - i) * ln(0.98))"
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id AS id, lang, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT r, id, lang, {words} AS w, {lines} AS lines, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM texts
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS v FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM split)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, v) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(8)) AS k) GROUP BY r
), stats AS (
  SELECT s.r, id, lang, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM split s LEFT JOIN covered c ON c.r = s.r
), binned AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, [
    least(4 * word_chars // greatest(n_words, 1), 64), 64 - least(8 * word_chars // greatest(n_words, 1), 64),
    least(32 * n_symbols // greatest(n_words, 1), 64), least(64 * n_dup_lines // greatest(n_lines, 1), 64),
    least(128 * n_repeat_words // greatest(n_words, 1), 64)] AS bins
  FROM stats
), known AS (
  SELECT doc_id AS id, max(quality) = 1 AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id
), labelled AS (
  SELECT b.*, k.good, {part} <= 2 AS fitting
  FROM (SELECT * FROM binned WHERE NOT base_failed QUALIFY row_number() OVER (PARTITION BY id ORDER BY lang, n_words, r) = 1) b
  JOIN known k ON k.id = b.id WHERE {part} <> 0
), grid AS (
  SELECT lang, rule, bin FROM (SELECT DISTINCT lang FROM labelled), (SELECT unnest(range(5)) AS rule), (SELECT unnest(range(65)) AS bin)
), counts AS (
  SELECT g.lang, g.rule, g.bin, count(*) FILTER (l.good) AS good, count(*) FILTER (NOT l.good) AS bad
  FROM grid g LEFT JOIN labelled l ON l.fitting AND l.lang IS NOT DISTINCT FROM g.lang AND l.bins[g.rule + 1] >= g.bin GROUP BY ALL
), purity AS (
  SELECT a.lang, a.rule, a.bin, max((2 * b.bad + 1) / (2 * (b.good + b.bad) + 2)) AS purity
  FROM counts a JOIN counts b ON a.lang IS NOT DISTINCT FROM b.lang AND a.rule = b.rule AND b.bin <= a.bin GROUP BY ALL
), suspicion AS (
  SELECT b.r, max(p.purity) AS suspicion
  FROM (SELECT r, lang, unnest(range(5)) AS rule, bins FROM binned) b
  JOIN purity p ON p.lang IS NOT DISTINCT FROM b.lang AND p.rule = b.rule AND p.bin = b.bins[b.rule + 1] GROUP BY b.r
), holdout AS (
  SELECT l.lang, s.suspicion FROM labelled l JOIN suspicion s ON s.r = l.r WHERE l.good AND NOT l.fitting
), tests AS (
  SELECT v.lang, v.suspicion, count(h.suspicion) FILTER (h.suspicion >= v.suspicion) AS lost, count(h.suspicion) AS n
  FROM (SELECT DISTINCT lang, purity AS suspicion FROM purity WHERE purity > 0.5) v
  LEFT JOIN holdout h ON h.lang IS NOT DISTINCT FROM v.lang GROUP BY ALL
), cutoffs AS (
  SELECT lang, min(suspicion) AS cutoff FROM tests
  WHERE lost < n AND list_sum(list_transform(range(0, lost + 1), lambda i: {term}))
    <= 0.05 / (SELECT count(*) FROM (SELECT DISTINCT lang FROM holdout)) GROUP BY lang
)
SELECT b.id AS doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(s.suspicion >= c.cutoff, false) AS kept
FROM binned b LEFT JOIN suspicion s ON s.r = b.r LEFT JOIN cutoffs c ON c.lang IS NOT DISTINCT FROM b.lang
"""


def codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    ctes = []
    for k in range(rounds + 1):
        ctes.append(f"""a{k} AS (
  SELECT vec_id, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT v.vec_id, v.p, b.e, list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - b.x[i]) * (v.x[i] - b.x[i]))) AS d
    FROM parts v JOIN b{k} b ON b.p = v.p
  ) GROUP BY vec_id, p
)""")
        if k < rounds:
            ctes.append(f"""b{k + 1} AS (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN (
    SELECT p, e, list(floor_sum // c ORDER BY i) AS x FROM (
      SELECT p, e, i, count(*) AS c, sum(y) - ((sum(y) % count(*)) + count(*)) % count(*) AS floor_sum
      FROM (SELECT a.p, a.e, generate_subscripts(v.x, 1) AS i, unnest(v.x) AS y FROM a{k} a JOIN parts v ON v.vec_id = a.vec_id AND v.p = a.p)
      GROUP BY p, e, i
    ) GROUP BY p, e
  ) m ON m.p = b.p AND m.e = b.e
)""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS HUGEINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
), parts AS (
  SELECT vec_id, p, x[p * (len(x) // {parts}) + 1:(p + 1) * (len(x) // {parts})] AS x FROM (SELECT vec_id, x, unnest(range({parts})) AS p FROM kept)
), b0 AS (
  SELECT p, rank() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries})
), {", ".join(ctes)}, codes AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(e AS INTEGER)), '' ORDER BY p) AS code, sum(d) AS error FROM a{rounds} GROUP BY vec_id
), totals AS (
  SELECT k.label, sum(c.error) AS label_error FROM kept k JOIN codes c ON c.vec_id = k.vec_id GROUP BY k.label
)
SELECT c.vec_id, c.code, CAST(c.error AS BIGINT) AS error, CAST(t.label_error AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM codes c JOIN kept k ON k.vec_id = c.vec_id JOIN totals t ON t.label IS NOT DISTINCT FROM k.label
"""


ORACLES: dict[str, str] = {"op11_merkle": manifest_sql(), "op12_rules": rules_sql(), "op13_vectorcodes": codes_sql()}
