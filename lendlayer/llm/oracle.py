"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_WORDS = r"[^\x20\x09-\x0D]+"

OP9 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM t
"""

OP10 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(words) >= 4 THEN list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))
         WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 80 * (x.n + y.n - m)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN n USING (doc_id)
"""

# Raking unrolled: three margins a round, as many rounds as the operator makes.
_ROUNDS = 10


def _raking() -> str:
    steps, last = [], "fit0"
    for r in range(_ROUNDS):
        for d in ("source", "lang", "topic"):
            now = f"fit{len(steps) + 1}"
            steps.append(
                f"{now} AS MATERIALIZED (SELECT f.source, f.lang, f.topic, tokens, w * target / sum(w) OVER (PARTITION BY f.{d}) AS w "
                f"FROM {last} f JOIN aim_{d} a ON a.k IS NOT DISTINCT FROM f.{d})"
            )
            last = now
    return ",\n".join(steps) + f",\nfitted AS (SELECT * FROM {last})"


# The largest relative margin error of the parts under the caps.
_ERROR = "greatest(" + ", ".join(f"max(abs(_m_{d} / aim_{d} - 1)) OVER ()" for d in ("source", "lang", "topic")) + ")"

_MARGINS = ", ".join(f"sum(least(w, cap)) OVER (PARTITION BY {d}) AS _m_{d}" for d in ("source", "lang", "topic"))
_MARGIN_NAMES = ", ".join(f"_m_{d}" for d in ("source", "lang", "topic"))


def _capped_block() -> str:
    """Five capped rounds from the recursion's last rows, while the margins don't fit and the last block helped."""
    inner = "SELECT * FROM held WHERE err > 1e-4 AND it < 40 AND (it = 0 OR err <= 0.99 * before)"
    for _ in range(5):
        for d in ("source", "lang", "topic"):
            part = f"OVER (PARTITION BY {d})"
            inner = (
                f"SELECT * EXCLUDE (m, stuck, free) REPLACE (w * CASE WHEN m < aim_{d} AND free > 0 THEN (aim_{d} - stuck) / free "
                f"WHEN m > aim_{d} THEN aim_{d} / m ELSE 1.0 END AS w) FROM (SELECT *, sum(least(w, cap)) {part} AS m, "
                f"sum(CASE WHEN w >= cap THEN cap ELSE 0.0 END) {part} AS stuck, sum(CASE WHEN w >= cap THEN 0.0 ELSE w END) {part} AS free FROM ({inner}))"
            )
    return inner


_AIM = """aim_{d} AS (SELECT k, power(have, 0.7) / sum(power(have, 0.7)) OVER () AS target
  FROM (SELECT {d} AS k, sum(tokens)::DOUBLE AS have FROM cells GROUP BY {d}))"""

OP2 = (
    rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, source, lang, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS words FROM documents
), t AS (
  SELECT doc_id, source, lang, len(words) AS tokens,
         coalesce(list_max(list_transform(words, lambda x: {{'n': length(x), 'w': x}})).w, '') AS longest FROM w
), r AS (
  SELECT doc_id, source, lang, tokens, 't' || (('0x' || substr(md5(longest), 1, 8))::BIGINT % 8) AS topic FROM t
), cells AS MATERIALIZED (
  SELECT source, lang, topic, sum(tokens) AS tokens FROM r GROUP BY ALL HAVING sum(tokens) > 0
), """
    + ",\n".join(_AIM.format(d=d) for d in ("source", "lang", "topic"))
    + ",\nfit0 AS (SELECT source, lang, topic, tokens, tokens::DOUBLE AS w FROM cells),\n"
    + _raking()
    + """,
whole AS (SELECT sum(tokens)::DOUBLE AS t, sum(w) AS w, 0.7 * sum(tokens) / sum(w) AS scale, max(w / tokens) AS most FROM fitted),
aims AS MATERIALIZED (
  SELECT f.*, x.target AS aim_source, y.target AS aim_lang, z.target AS aim_topic FROM fitted f
  JOIN aim_source x ON x.k IS NOT DISTINCT FROM f.source JOIN aim_lang y ON y.k IS NOT DISTINCT FROM f.lang
  JOIN aim_topic z ON z.k IS NOT DISTINCT FROM f.topic
),
begun AS (SELECT a.* REPLACE (a.w / whole.w AS w), a.w AS raked, tokens / (0.7 * t) AS cap FROM aims a, whole),
"""
    + f"""held AS (
  SELECT 0 AS it, * EXCLUDE ({_MARGIN_NAMES}), {_ERROR} AS err, 1e300::DOUBLE AS before FROM (SELECT *, {_MARGINS} FROM begun)
  UNION ALL
  SELECT it + 1, * EXCLUDE (it, err, before, {_MARGIN_NAMES}), {_ERROR}, err FROM (SELECT *, {_MARGINS} FROM ({_capped_block()}))
),
done AS MATERIALIZED (SELECT * FROM held WHERE it = (SELECT max(it) FROM held)),
newton AS (
  SELECT 0.7 * t / (SELECT sum(w) FROM done) AS scale, 0::DOUBLE AS last FROM whole
  UNION ALL
  SELECT raised, scale FROM (
    SELECT n.scale, (0.7 * any_value(t) - sum(CASE WHEN d.w * n.scale >= tokens THEN tokens ELSE 0 END)) / nullif(sum(CASE WHEN d.w * n.scale >= tokens THEN 0 ELSE d.w END), 0) AS raised
    FROM newton n, done d, whole GROUP BY n.scale
  ) WHERE raised > scale * (1 + 1e-12)
),
s AS (SELECT whole.scale * most > 1 AS capped, CASE WHEN whole.scale * most > 1 THEN (SELECT max(scale) FROM newton) ELSE whole.scale END AS scale FROM whole),
odds AS (SELECT source, lang, topic, raked AS w, least(1.0, CASE WHEN capped THEN w ELSE raked END / tokens * scale) AS p FROM done, s)
SELECT r.doc_id, r.source, r.lang, r.topic, r.tokens, round(coalesce(w, 0.0), 9) AS weight, round(coalesce(p, 0.7), 6) AS probability,
       ('0x' || substr(md5('42:' || coalesce(r.doc_id::VARCHAR, '')), 1, 13))::BIGINT / power(16.0, 13) < coalesce(p, 0.7) AS sampled
FROM r LEFT JOIN odds o ON o.source IS NOT DISTINCT FROM r.source AND o.lang IS NOT DISTINCT FROM r.lang AND o.topic = r.topic
"""
)

# Window places follow from prefix sums alone, so the formatted length can be added up without formatting.
OP4 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok'
), t AS (
  SELECT *, len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9 	-
]')) + 4 AS tokens,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS ord FROM c
), u AS (
  SELECT *, max(CASE WHEN ord = 1 AND role = 'system' THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS first_tokens,
         sum(tokens) OVER (PARTITION BY conv_id ORDER BY ord) AS total FROM t
), v AS (
  SELECT *, ord = 1 AND first_tokens > 0 AS opening, total - tokens - first_tokens AS p, total - first_tokens AS q,
         greatest(1024 - 256 - first_tokens, 256) AS room,
         length('<|im_start|>') + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\n')) + 1
         + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + length('<|im_end|>') + 1 AS chars FROM u
), x AS (
  SELECT *, CASE WHEN opening OR p = 0 THEN 0 ELSE 2 * (p // room) + CASE WHEN (q - 1) // room > p // room THEN 1 ELSE 0 END END AS win FROM v
), wins AS (SELECT conv_id, win, min(p) AS p0 FROM x WHERE NOT opening GROUP BY ALL),
own AS (SELECT conv_id, sum(chars) AS n FROM x GROUP BY 1),
told AS (
  SELECT x.conv_id, sum(chars) AS n FROM x JOIN wins w ON w.conv_id IS NOT DISTINCT FROM x.conv_id AND w.p0 >= x.q AND w.p0 <= x.p + 256
  WHERE NOT opening GROUP BY 1
), again AS (
  SELECT x.conv_id, sum(chars) AS n FROM x JOIN wins w ON w.conv_id IS NOT DISTINCT FROM x.conv_id AND w.win > 0 WHERE opening GROUP BY 1
), d AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY ord)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY ord) FILTER (role = 'assistant'), '') AS loss FROM x GROUP BY 1
)
SELECT d.conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       (own.n + coalesce(told.n, 0) + coalesce(again.n, 0))::BIGINT AS formatted_chars
FROM d JOIN own ON own.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN again ON again.conv_id IS NOT DISTINCT FROM d.conv_id
"""

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
), w AS (
  SELECT doc, lang, source, translate(unnest(words), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d
), kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), about AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counted AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM counted GROUP BY ALL),
given AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(s.total, 0) + a.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 1)) // (a.total + a.v) AS q
  FROM groups g JOIN about a USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source
), priced AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
  FROM given x JOIN given y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
), found AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN priced p ON p.lang = x.lang AND p.source = x.source AND p.item = y.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM given WHERE n > 0 AND p > q
)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found
QUALIFY part = 'pair' OR rank <= 200
"""


def _lloyd() -> str:
    """Two rounds of nearest entries and floored means, unrolled, and the last assignment."""
    steps = []
    for r in range(3):
        steps.append(
            f"""near{r} AS MATERIALIZED (SELECT row, part, min(off * 64 + entry) AS best FROM (
  SELECT x.row, x.part, b.entry, sum((x.c - b.c) * (x.c - b.c))::HUGEINT AS off FROM comps x JOIN book{r} b ON b.part = x.part AND b.pos = x.pos GROUP BY ALL) GROUP BY ALL)"""
        )
        if r < 2:
            steps.append(
                f"""book{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, coalesce((total - ((total % n) + n) % n) // n, b.c)::BIGINT AS c
  FROM book{r} b LEFT JOIN (SELECT x.part, (best % 64)::INTEGER AS entry, x.pos, sum(x.c)::HUGEINT AS total, count(*) AS n
    FROM comps x JOIN near{r} USING (row, part) GROUP BY ALL) m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos)"""
            )
    return ",\n".join(steps)


OP12 = (
    r"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS row, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), flat AS (SELECT row, len(v) // 16 AS width, unnest(v) AS c, unnest(range(len(v))) AS i FROM k),
comps AS MATERIALIZED (SELECT row, (i // width)::INTEGER AS part, (i % width)::INTEGER AS pos, c FROM flat),
book0 AS MATERIALIZED (SELECT part, row::INTEGER AS entry, pos, c FROM comps WHERE row < 64),
"""
    + _lloyd()
    + """,
coded AS (
  SELECT row, string_agg(lpad(lower(to_hex((best % 64)::BIGINT)), 2, '0'), '' ORDER BY part) AS code, sum(best // 64)::BIGINT AS error FROM near2 GROUP BY row
), digest AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM k JOIN coded USING (row), digest
"""
)

ORACLE = {"op11_source_divergence_audit": OP11, "op12_vector_code_compression": OP12, "op2_mixing": OP2, "op4_chat_formatting": OP4, "op9_exact_dedup": OP9, "op10_minhash_near_dedup": OP10}
