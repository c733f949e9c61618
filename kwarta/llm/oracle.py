"""DuckDB SQL for the operators that SQL can express."""

from kwarta.llm.licenses import BETWEEN, CANONICAL, EXPRESSION, PARAGRAPH, SPACE, known_texts
from kwarta.llm.secrets import BASE, COMPLEMENT, KINDS, SCOPE


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    out = f"lower({column})"
    for pattern, replacement in CANONICAL:
        out = f"regexp_replace({out}, {_text(pattern)}, {_text(replacement.replace('$', chr(92)))}, 'g')"
    return out


def _flat(form: str) -> str:
    return f"trim(regexp_replace({form}, {_text(SPACE)}, ' ', 'g'))"


_KNOWN = ", ".join(f"({_text(license_id)}, {_text(text)})" for license_id, text in sorted(set(known_texts())))



def _spans(kind: str) -> str:
    """Array of [start, end] of a kind in `text`, from what its pattern leaves between matches."""
    pattern, group, least, most = KINDS[kind]
    p = _text(pattern)
    return f"""(
        SELECT list([s, s + w] ORDER BY s) FILTER (m >= {least} AND m <= {most or 2**31 - 1}) FROM (
            SELECT sum(g + w) OVER (ORDER BY i) - w AS s, w, m FROM (
                SELECT unnest(range(1, len(a) + 1)) AS i, unnest(list_transform(a, lambda x: length(x))) AS w,
                       unnest(list_transform(list_slice(b, 1, len(a)), lambda x: length(x))) AS g, unnest(list_transform(c, lambda x: length(x))) AS m
                FROM (SELECT regexp_extract_all(text, {p}) AS a, regexp_split_to_array(text, {p}) AS b, regexp_extract_all(text, {p}, {group}) AS c))))"""


_PARTS = " UNION ALL ".join(
    f"SELECT row, '{kind}' AS kind, {order} AS ord, unnest({kind}) AS span FROM found" for order, kind in enumerate(KINDS))
_NEEDS = " OR ".join(
    f"(w.kind = '{kind}' AND b.kind IN ({', '.join(map(_text, parts))}))" for kind, parts in COMPLEMENT.items())

#: Levels of the tree that the SQL goes through: enough for 16 ** 5 rows of a source and 16 ** 4 sources.
_ROW_LEVELS, _SOURCE_LEVELS = 5, 4


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _levels(name: str, count: int) -> str:
    """Runs of sixteen and the nodes above them, level by level: {name}r0, {name}1, {name}r1 .."""
    return ", ".join(f"""
        {name}r{k} AS (SELECT tree, idx // 16 AS run, m, list(digest ORDER BY idx) AS kids FROM {name}{k} GROUP BY ALL),
        {name}{k + 1} AS (SELECT tree, run AS idx, (m + 15) // 16 AS m,
                                 CASE WHEN m = 1 THEN kids[1] ELSE sha256(array_to_string(kids, '')) END AS digest FROM {name}r{k})"""
        for k in range(count))


def _fold(name: str, rows: str, count: int) -> str:
    """Rows' digests and proofs carried up through those runs: {rows}1, {rows}2 .."""
    rest = "r.kids[1 : f.at % 16] || {} r.kids[f.at % 16 + 2 :]"
    return ", ".join(f"""
        {rows}{k + 1} AS (SELECT f.id, f.tree, f.at // 16 AS at,
            CASE WHEN r.m = 1 THEN f.cur ELSE sha256(array_to_string({rest.format('[f.cur] ||')}, '')) END AS cur,
            f.proof || CASE WHEN r.m = 1 THEN '' ELSE array_to_string({rest.format('')}, '') END AS proof
            FROM {rows}{k} f JOIN {name}r{k} r ON r.tree = f.tree AND r.run = f.at // 16)""" for k in range(count))


ORACLE_SQL = {
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d FROM pages),
             s AS (SELECT *, CASE WHEN strlen(html) >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS top FROM p)
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, d AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to
        FROM s
    """,
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               row_number() OVER (g ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    # for pages laid out as the test tables' are: one article, of headings, paragraphs and bold text
    "op4_html": r"""
        WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS x FROM pages),
             b AS (SELECT page_id, url, regexp_replace(regexp_replace(x, '</?(p|h1|br)>', ' ', 'g'), '</?b>', '', 'g') AS x FROM a),
             c AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(
                       regexp_replace(x, '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM b)
        SELECT page_id, url, text, length(text) AS n_chars FROM c
    """,
    "op5_near_dedup": r"""
        WITH RECURSIVE d AS (
                 SELECT doc_id, regexp_extract_all(
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
                 FROM documents),
             s AS (SELECT doc_id, list_distinct(list_transform(
                       range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i : i + 4], ' '))) AS g
                   FROM d WHERE len(w) > 0),
             e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
             p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
                   FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
             l AS (SELECT a, b FROM p WHERE 100 * c >= 75 * (na + nb - c)),
             sym AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
             r AS (SELECT a AS doc_id, b AS reach FROM sym UNION SELECT r.doc_id, sym.b FROM r JOIN sym ON r.reach = sym.a),
             low AS (SELECT doc_id, min(reach) AS m FROM r GROUP BY 1)
        SELECT doc_id, coalesce(len(g), 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
               doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
        FROM d LEFT JOIN s USING (doc_id) LEFT JOIN low USING (doc_id)
    """,
    "op8_licenses": f"""
        WITH known AS (SELECT DISTINCT license, {_flat(_canonical('t'))} AS form FROM (VALUES {_KNOWN}) AS k(license, t)),
             docs AS (SELECT doc_id, row_number() OVER () AS row, {_canonical("coalesce(text, '')")} AS form FROM documents),
             parts AS (
                 SELECT row, true AS whole, form FROM docs UNION ALL
                 SELECT row, false, unnest(regexp_split_to_array(form, '\\n')) FROM docs UNION ALL
                 SELECT row, false, unnest(regexp_split_to_array(form, {_text(PARAGRAPH)})) FROM docs UNION ALL
                 SELECT row, false, unnest(regexp_split_to_array(trim(regexp_replace(line, {_text('^.*' + EXPRESSION)}, '')), {_text(BETWEEN)}))
                 FROM (SELECT row, unnest(regexp_split_to_array(form, '\\n')) AS line FROM docs) WHERE contains(line, {_text(EXPRESSION)})),
             hits AS (SELECT DISTINCT row, license, whole FROM (SELECT row, whole, {_flat('form')} AS form FROM parts) JOIN known USING (form)),
             listed AS (SELECT row, string_agg(DISTINCT license, ',' ORDER BY license) AS found, count(DISTINCT license) AS n,
                               min(license) FILTER (whole) AS w FROM hits GROUP BY row)
        SELECT doc_id, coalesce(found, '') AS licenses, coalesce(n, 0) AS n_licenses, w AS whole_license,
               sha256({_flat('form')}) AS canonical_sha256
        FROM docs LEFT JOIN listed USING (row)
    """,
    "op13_merkle": f"""
        WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                         lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
             d AS (SELECT row_number() OVER () AS id, documents.*, {_leaf("text")} AS leaf,
                          {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered,
                          xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                              lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 5 = 0 AS hit FROM documents, crc),
             o AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM d),
             n AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS m FROM o),
             t0 AS (SELECT tree, idx, m, leaf AS digest FROM n), {_levels('t', _ROW_LEVELS)},
             u0 AS (SELECT 0 AS tree, tree AS idx, count(*) OVER () AS m, digest FROM t{_ROW_LEVELS}), {_levels('u', _SOURCE_LEVELS)},
             f0 AS (SELECT id, tree, idx AS at, CASE WHEN hit THEN lowered ELSE leaf END AS cur, '' AS proof FROM n), {_fold('t', 'f', _ROW_LEVELS)},
             g0 AS (SELECT id, 0 AS tree, tree AS at, cur, proof FROM f{_ROW_LEVELS}), {_fold('u', 'g', _SOURCE_LEVELS)}
        SELECT n.doc_id, n.leaf, s.digest AS subroot, r.digest AS root, sha256(g.proof) AS proof_sha256, g.cur AS folded_root, g.cur = r.digest AS verified
        FROM n JOIN g{_SOURCE_LEVELS} g USING (id) JOIN u0 s ON s.idx = n.tree, u{_SOURCE_LEVELS} r
    """,
    "op7_secrets": f"""
        WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
             found AS (SELECT row, {', '.join(f'{_spans(k)} AS {k}' for k in KINDS)} FROM docs),
             parts AS (SELECT row, kind, ord, CAST(span[1] AS BIGINT) AS s, CAST(span[2] AS BIGINT) AS e FROM ({_PARTS})),
             base AS (SELECT * FROM parts WHERE kind IN ({', '.join(map(_text, BASE))})),
             linked AS (
                 SELECT * FROM parts w WHERE EXISTS (
                     SELECT 1 FROM base b WHERE b.row = w.row AND b.s <= w.e + {SCOPE} AND w.s <= b.e + {SCOPE} AND ({_NEEDS}))
                 AND NOT EXISTS (SELECT 1 FROM base b WHERE b.row = w.row AND b.s < w.e AND w.s < b.e)),
             listed AS (SELECT row, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord, e) AS spans
                        FROM (SELECT * FROM base UNION ALL SELECT * FROM linked) GROUP BY row),
             counted AS (SELECT row, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c,
                                count(*) FILTER (kind = 'hex') AS h, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) AS own
                         FROM base GROUP BY row),
             more AS (SELECT row, count(*) AS n FROM linked GROUP BY row)
        SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
               sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n, 0) AS n_linked
        FROM docs LEFT JOIN listed USING (row) LEFT JOIN counted USING (row) LEFT JOIN more USING (row)
    """,
}
