"""DuckDB SQL for the rows of queries that SQL can express, by another way than the operators'."""

from __future__ import annotations

from eventloom.llm.set_join import SHARE
from eventloom.llm.spellings import DROP_EACH, MIN_LENGTH, MIN_TIMES, TIMES_MORE
from eventloom.llm.vector_codes import ENTRIES, PARTS, ROUNDS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _vector_codes() -> str:
    """All distances of every round, as dot products of doubles (exact: whole numbers below 2 ** 53)."""
    steps = [f"""
        kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v FROM embeddings
                 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        step AS (SELECT max(len(v)) // {PARTS} AS w FROM kept),
        parts AS (SELECT vec_id, label, p, v[p * w + 1 : (p + 1) * w] AS v FROM kept, step, range({PARTS}) AS t(p)),
        sized AS (SELECT *, list_dot_product(v, v) AS size FROM parts),
        book0 AS (SELECT p, e, v FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < {ENTRIES})"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""
        near{r} AS (SELECT vec_id, any_value(label) AS label, p, any_value(s.v) AS v,
                        min({{'d': s.size - 2 * list_dot_product(s.v, b.v) + list_dot_product(b.v, b.v), 'e': e}}) AS best
                    FROM sized s JOIN book{r} b USING (p) GROUP BY vec_id, p)""")
        if r < ROUNDS:
            steps.append(f"""
        mean{r} AS (SELECT p, e, list(m ORDER BY i) AS v FROM (
                        SELECT p, best.e AS e, i, floor(sum(v[i]) / count(*)) AS m
                        FROM near{r}, step, range(1, w + 1) AS t(i) GROUP BY ALL) GROUP BY p, e),
        book{r + 1} AS (SELECT p, e, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN mean{r} m USING (p, e))""")
    return f"""
        WITH {','.join(steps)},
        codes AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best.e::INT), '' ORDER BY p) AS code,
                      sum(best.d)::BIGINT AS error FROM near{ROUNDS} GROUP BY vec_id),
        entries AS (SELECT sha256(string_agg((v[i])::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS digest
                    FROM book{ROUNDS}, step, range(1, w + 1) AS t(i))
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, digest AS codebooks_sha256
        FROM codes, entries"""


def _crc32_table() -> list[int]:
    """The byte table of the reflected polynomial 0xEDB88320."""
    def entry(value: int) -> int:
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        return value

    return [entry(k) for k in range(256)]


def _spellings() -> str:
    """Every word against every other that begins or ends with the same three letters."""
    accented = "".join(map(chr, range(0xC0, 0x100)))
    # One byte for each letter, as levenshtein counts bytes.
    plain = "".join(chr(k) for k in range(33, 127) if not chr(k).islower() and chr(k) != "'")[: len(accented)]
    return f"""
        WITH RECURSIVE runs AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS name, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-zÀ-ÿ]+')) AS run
            FROM documents),
        counted AS (SELECT run, count(*) AS k, hex(encode(name || ':' || run)) AS hx FROM runs GROUP BY name, run),
        hashed AS (SELECT run, k, xor(4294967295, list_reduce(
                list_transform(range(length(hx) // 2), lambda i: ('0x' || hx[2 * i + 1 : 2 * i + 2])::BIGINT),
                lambda c, b: xor(c >> 8, ({_crc32_table()}::BIGINT[])[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) AS h
            FROM counted WHERE length(run) >= {MIN_LENGTH}),
        words AS (
            SELECT CASE WHEN h % {DROP_EACH} = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word,
                sum(k)::BIGINT AS n, translate(word, '{accented}', '{plain}') AS bytes
            FROM hashed GROUP BY word HAVING length(word) >= {MIN_LENGTH} AND sum(k) >= {MIN_TIMES}),
        near AS (
            SELECT a.word, a.n, b.word AS other, b.n AS times FROM words a JOIN words b
            ON a.word <> b.word AND abs(length(a.word) - length(b.word)) <= 1
                AND (a.bytes[:3] = b.bytes[:3] OR a.bytes[-3:] = b.bytes[-3:]) AND levenshtein(a.bytes, b.bytes) = 1),
        best AS (SELECT word, count(*) AS n_near, min({{'less': -times, 'form': other}}) AS b FROM near GROUP BY word),
        forms AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= {TIMES_MORE} * n THEN b.form END AS form,
                CASE WHEN -b.less >= {TIMES_MORE} * n THEN -b.less END AS form_n
            FROM words LEFT JOIN best USING (word)),
        chain AS (
            SELECT word, word AS root FROM forms
            UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON chain.root = forms.word WHERE forms.form IS NOT NULL)
        SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c USING (word)
        WHERE c.root IN (SELECT word FROM forms WHERE form IS NULL)"""


def _set_join() -> str:
    """Common shingles of all pairs of different sets, counted under each shingle."""
    return f"""
        WITH RECURSIVE worded AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+'), []) AS w
            FROM documents),
        sets AS (
            SELECT r, doc_id, list_sort(list_distinct(CASE WHEN len(w) > 2 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM worded),
        named AS (SELECT *, dense_rank() OVER (ORDER BY s) AS node, len(s) AS n FROM sets),
        nodes AS (SELECT node, any_value(s) AS s, any_value(n) AS n, min(doc_id) AS first FROM named WHERE n > 0 GROUP BY node),
        postings AS (SELECT node, n, unnest(s) AS h FROM nodes),
        links AS (
            SELECT a.node AS a, b.node AS b FROM postings a JOIN postings b ON a.h = b.h AND a.node <> b.node
            GROUP BY a.node, b.node HAVING 100 * count(*) >= {SHARE} * (any_value(a.n) + any_value(b.n) - count(*))),
        reach AS (
            SELECT node AS a, node AS b FROM nodes
            UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT reach.a AS node, min(first) AS component_id FROM reach JOIN nodes ON reach.b = nodes.node GROUP BY reach.a)
        SELECT doc_id, n::BIGINT AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE component_id END AS component_id
        FROM named LEFT JOIN least USING (node)"""


ORACLES = {"op11_spellings": _spellings(), "op12_vector_codes": _vector_codes(), "op13_set_join": _set_join()}
