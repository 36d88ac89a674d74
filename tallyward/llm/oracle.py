"""SQL counterparts for a second engine, of the numbered queries that SQL can express."""

from __future__ import annotations

from tallyward.llm.licences import AGREEING, BASE_PHRASES, TEMPLATES, indexed

_NEW = "chr(13) || chr(10)"


def _record(html: str) -> str:
    return (
        f"'WARC/1.1' || {_NEW} || 'WARC-Type: response' || {_NEW} || 'WARC-Record-ID: <urn:page:' || page_id || '>' || {_NEW} || "
        f"'WARC-Target-URI: ' || url || {_NEW} || 'Content-Type: text/html; charset=utf-8' || {_NEW} || "
        f"'Content-Length: ' || strlen({html}) || {_NEW} || {_NEW} || {html} || {_NEW} || {_NEW}"
    )


OP7 = f"""
WITH copies AS (
    SELECT page_id, url, html,
        CASE page_id % 97
            WHEN 13 THEN substr(html, 1, length(html) // 2) || '~' || substr(html, length(html) // 2 + 2)
            WHEN 57 THEN substr(html, 1, length(html) - 1)
            ELSE html END AS copy
    FROM pages
), records AS (
    SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS n, {_record("html")} AS record,
        CASE WHEN page_id % 97 = 91 THEN NULL ELSE {_record("copy")} END AS found
    FROM copies
), hashed AS (
    SELECT page_id, n // 4096 AS file, n, strlen(record) AS length, sha256(record) AS sha256, sha256(found) AS theirs,
        strlen(found) AS found_length, CASE WHEN page_id % 97 = 31 THEN 2 ELSE 1 END AS times
    FROM records
), placed AS (
    SELECT *, CAST(sum(length) OVER (PARTITION BY file ORDER BY n) - length AS BIGINT) AS "offset",
        CAST(sum(coalesce(found_length, 0) * times) OVER (ORDER BY n) - found_length * times AS BIGINT) AS found_offset
    FROM hashed
)
SELECT page_id, file, "offset", length, sha256, sha256 IS NOT DISTINCT FROM theirs AS intact,
    CASE WHEN sha256 IS NOT DISTINCT FROM theirs THEN NULL ELSE theirs END AS found_sha256, found_offset,
    CASE WHEN theirs IS NULL THEN 'missing' WHEN sha256 = theirs THEN 'intact' ELSE 'altered' END AS finding
FROM placed
UNION ALL
SELECT page_id, NULL, NULL, NULL, NULL, false, theirs, found_offset + found_length, 'surplus' FROM placed WHERE times = 2
"""


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_any_case(w).replace("_", "_?") for w in ("password", "passwd", "secret", "token", "api_key"))
# rank, kind, pattern, group whose length counts, least length
_KINDS = (
    (0, "assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    (1, "access", "AKIA[A-Z0-9]+", 0, 20),
    (2, "hex", "[0-9a-f]+", 0, 24),
    (3, "github", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    (4, "jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 20),
    (5, "pem", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 20),
)


def _spans(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Matches of one kind: gaps and matches alternate, so their lengths give the places."""
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""
        SELECT doc_id, {rank} AS rank, '{kind}' AS kind, first, first + length(m[i]) AS stop FROM (
            SELECT doc_id, i, m, v, list_sum(list_transform(g[1:i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS first
            FROM (
                SELECT doc_id, g, m, v, unnest(range(1, len(m) + 1)) AS i FROM (
                    SELECT doc_id, string_split_regex(text, {quoted}) AS g, regexp_extract_all(text, {quoted}, 0) AS m,
                        regexp_extract_all(text, {quoted}, {group}) AS v
                    FROM documents WHERE regexp_matches(text, {quoted}))))
        WHERE length(v[i]) >= {least}"""


OP3 = f"""
WITH found AS ({" UNION ALL ".join(_spans(*k) for k in _KINDS)}),
told AS (
    SELECT doc_id, rank, kind, first, kind || ':' || CAST(first AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM found
), per_doc AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex, string_agg(span, ',' ORDER BY first, rank) AS spans,
        string_agg(span, ',' ORDER BY first, rank) FILTER (rank < 3) AS base
    FROM told GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN per_doc USING (doc_id)
"""

OP10 = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
        lambda x: x <> '') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
        FROM words)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * pairs.n >= 75 * (x.n + y.n - pairs.n)
), both_ways AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
    SELECT a, b FROM both_ways UNION SELECT reach.a, e.b FROM reach JOIN both_ways e ON reach.b = e.a
), lowest AS (
    SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
    doc_id <= coalesce(low, doc_id) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""


_POSTINGS = ", ".join(f"('{w}', {t}, {p})" for w, held in indexed(TEMPLATES).items() for t, p in held)
_TEMPLATES = ", ".join(f"({k}, '{t.label}', ' {t.mandatory} ')" for k, t in enumerate(TEMPLATES))
_PHRASES = " UNION ALL ".join(
    f"SELECT doc_id, '{label}' AS label, i FROM tokens WHERE "
    + " AND ".join(f"{'w' if not k else f'w{k}'} = '{w}'" for k, w in enumerate(phrase.split()))
    for phrase, label in BASE_PHRASES.items()
)

OP9 = rf"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents
), tokens AS (
    SELECT doc_id, i - 1 AS i, ws[i] AS w, ws[i + 1] AS w1, ws[i + 2] AS w2 FROM (
        SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM split)
), postings(w, template, place) AS (VALUES {_POSTINGS}), templates(template, label, needed) AS (VALUES {_TEMPLATES}),
sizes AS (SELECT template, count(DISTINCT w) AS size FROM postings GROUP BY template),
placed AS (SELECT doc_id, i, w FROM tokens WHERE w IN (SELECT w FROM postings)),
rarity AS (
    SELECT w, ln((SELECT count(*) + 1 FROM documents) / (count(DISTINCT doc_id) + 1)) AS r FROM placed GROUP BY w
), chosen AS (
    SELECT doc_id, w, r FROM (SELECT DISTINCT doc_id, w FROM placed) JOIN rarity USING (w)
), every AS (SELECT doc_id, sum(r) AS total FROM chosen GROUP BY doc_id),
votes AS (
    SELECT DISTINCT doc_id, template, i - place AS start, w, r
    FROM placed JOIN chosen USING (doc_id, w) JOIN postings USING (w)
), agreed AS (
    SELECT doc_id, template, start, count(*) AS n, sum(r) AS r FROM votes GROUP BY 1, 2, 3
), matched AS (
    SELECT doc_id, label, CASE WHEN total > 0 THEN agreed.r / total ELSE 1 END AS score
    FROM agreed JOIN every USING (doc_id) JOIN sizes USING (template) JOIN templates USING (template) JOIN split USING (doc_id)
    WHERE n >= size * {AGREEING} AND contains(' ' || array_to_string(ws, ' ') || ' ', needed)
), base AS ({_PHRASES}),
based AS (
    SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM base GROUP BY doc_id
), named AS (
    SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT doc_id, label FROM base UNION ALL SELECT doc_id, label FROM matched) GROUP BY doc_id
), best AS (SELECT doc_id, max(score) AS score FROM matched GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    round(least(1.0, CASE WHEN n_base > 0 THEN greatest(coalesce(score, 0), 0.5) ELSE coalesce(score, 0) END), 6) AS score
FROM split LEFT JOIN based USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN best USING (doc_id)
"""


def _tree(name: str, start: str, levels: int) -> str:
    """Levels of a forest of rows ``tree, i, h, n``, and each node's siblings on its left and right."""
    run = "PARTITION BY tree, i // 3 ORDER BY i ROWS BETWEEN"
    parts = [f"{name}0 AS MATERIALIZED ({start})"]
    for k in range(levels):
        parts.append(
            f"{name}{k + 1} AS MATERIALIZED (SELECT tree, i // 3 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) "
            f"ELSE any_value(h) END AS h, (any_value(n) + 2) // 3 AS n FROM {name}{k} GROUP BY tree, i // 3)"
        )
        parts.append(
            f"{name}_beside{k} AS (SELECT tree, i, n, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
            f"coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})"
        )
    return ", ".join(parts)


def _fold(name: str, start: str, tree: str, levels: int) -> str:
    """Rows of ``start`` with the hash folded and the siblings gathered up a tree's levels."""
    parts = [f"{name}0 AS ({start})"]
    for k in range(levels):
        parts.append(
            f"{name}{k + 1} AS (SELECT a.* REPLACE (CASE WHEN b.n > 1 THEN sha256(l || own || r) ELSE own END AS own, "
            f"CASE WHEN b.n > 1 THEN beside || l || r ELSE beside END AS beside) "
            f"FROM {name}{k} a JOIN {tree}_beside{k} b ON a.tree = b.tree AND a.i // {3**k} = b.i)"
        )
    return ", ".join(parts)


def _told(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


#: Levels enough for 3^13 documents a source and 3^4 sources.
_LOW, _HIGH = 13, 4
_FIELDS = " || ".join(_told(c) for c in ("doc_id", "source", "lang", "n_chars"))
_CHECKSUM = (
    "list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c))), "
    "lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))"
)

# the checksum's last step, which inverts all bits, is left out: odd here is even there
OP11 = f"""
WITH leaves AS MATERIALIZED (
    SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, sha256({_FIELDS} || {_told("text")}) AS leaf,
        sha256({_FIELDS} || {_told("CASE WHEN " + _CHECKSUM + " % 2 = 1 THEN replace(text, chr(10), '') ELSE text END")}) AS again
    FROM documents
), numbered AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n
    FROM leaves
), {_tree("low", "SELECT tree, i, leaf AS h, n FROM numbered", _LOW)},
{_tree("high", f"SELECT 0 AS tree, tree AS i, h, count(*) OVER () AS n FROM low{_LOW}", _HIGH)},
{_fold("inside", "SELECT doc_id, tree, i, leaf, again AS own, '' AS beside FROM numbered", "low", _LOW)},
{_fold("above", f"SELECT doc_id, tree AS source, 0 AS tree, tree AS i, leaf, own, beside FROM inside{_LOW}", "high", _HIGH)}
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(beside) AS proof_sha256, own AS folded_root, own = t.h AS verified
FROM above{_HIGH} a JOIN low{_LOW} s ON s.tree = a.source JOIN high{_HIGH} t ON true
"""

OP13 = r"""
WITH sized AS MATERIALIZED (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, md5(coalesce(text, '')) AS m
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source
), weighed AS (
    SELECT source, source_size, CAST([3, 1, 2][place % 3 + 1] AS DOUBLE) AS weight, source_size * 2.0::DOUBLE / weight AS full_at FROM sources
), levels AS (
    SELECT full_at, source, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * (sum(source_size) OVER w - source_size))
        / (sum(weight) OVER () - (sum(weight) OVER w - weight)) AS level
    FROM weighed WINDOW w AS (ORDER BY full_at, source NULLS FIRST ROWS UNBOUNDED PRECEDING)
), risen AS (
    SELECT arg_min(level, (full_at, source IS NOT NULL, source)) AS level FROM levels WHERE level <= full_at
), goals AS (
    SELECT source, source_size, least(source_size * 2.0::DOUBLE, weight * level) AS target,
        CASE WHEN source_size > 0 THEN CAST(round(target / source_size * 16777216) AS BIGINT) ELSE 0 END AS expected,
        CAST('0x' || substr(md5('mix:' || coalesce('=' || source, '-')), 1, 6) AS BIGINT) AS shift
    FROM weighed, risen
), placed AS (
    SELECT doc_id, size, source_size, target, expected,
        (row_number() OVER (PARTITION BY sized.source ORDER BY size, doc_id NULLS FIRST, m) - 1) * expected + shift AS start
    FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies
FROM (SELECT *, CAST((start + expected) // 16777216 - start // 16777216 AS BIGINT) AS copies FROM placed)
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op3_blob_ledger_secrets": OP3,
        "op7_merkle_fixity_audit": OP7,
        "op9_positional_licence_index": OP9,
        "op10_minhash_inverted_join": OP10,
        "op11_merkle_slot_pivot": OP11,
        "op13_systematic_mixing": OP13,
    }
