"""DuckDB twins of those queries that SQL can state."""

from __future__ import annotations

import string

from millrace.llm.chat import END, TEXT, TURN

UPPER, LOWER, PUNCTUATION = string.ascii_uppercase, string.ascii_lowercase, string.punctuation


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _words(text: str) -> str:
    """List of the words of a text."""
    return f"list_filter(string_split_regex({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


LOWERED = f"translate(coalesce(text, ''), {_quoted(UPPER)}, {_quoted(LOWER)})"
PLAIN = (
    f"translate(coalesce(text, ''), {_quoted(UPPER + PUNCTUATION)}, "
    f"{_quoted(LOWER + ' ' * len(PUNCTUATION))})"
)


def _shingles(size: int) -> str:
    """Runs of ``size`` of the words w, each as one string."""
    return (
        f"unnest(list_transform(range(1, len(w) - {size - 2}), "
        f"lambda k: array_to_string(w[k:k + {size - 1}], ' ')))"
    )


def chat(control: str) -> str:
    """Digests of turns and of assistant texts; the template's marks and escapes add to the length."""

    def escaped(text: str) -> str:
        return f"length({text}) + length(regexp_replace({text}, '[^\\\\<\\[]', '', 'g'))"

    marks = len(TURN) + len(TEXT) + len(END)
    said = "coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), '')"
    return f"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL SELECT -7, 0, 'user', {_quoted(control)}
            UNION ALL SELECT -7, 1, 'assistant', {_quoted(control)})
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn))
                   AS turns_sha256,
               CAST(length({said}) AS BIGINT) AS loss_chars, sha256({said}) AS loss_sha256,
               CAST(sum({marks} + {escaped('role')} + {escaped('text')}) AS BIGINT)
                   AS formatted_chars
        FROM turns GROUP BY conv_id"""


def repeats(window: int) -> str:
    """Words covered by a window whose words start elsewhere as well."""
    return f"""
        WITH d AS (SELECT doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
        p AS (SELECT doc_id, w, unnest(range(1, len(w) - {window - 2})) AS k FROM d),
        h AS (SELECT doc_id, k, array_to_string(w[k:k + {window - 1}], ' ') AS s FROM p),
        r AS (SELECT s FROM h GROUP BY s HAVING count(*) > 1),
        starts AS (SELECT doc_id, k FROM h SEMI JOIN r USING (s)),
        gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + {window})) AS place FROM starts),
        places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d),
        kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
                 FROM places ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)"""


def containment(words: int, percent: int) -> str:
    """Items of which a document has enough shingles; items have at least ``words`` words."""
    return f"""
        WITH d AS (SELECT doc_id, {_words(PLAIN)} AS w FROM documents),
        i AS (SELECT item_id, {_words(PLAIN)} AS w FROM benchmark),
        ds AS (SELECT DISTINCT doc_id, {_shingles(words)} AS s FROM d),
        si AS (SELECT DISTINCT item_id, {_shingles(words)} AS s FROM i),
        n AS (SELECT item_id, count(*) AS n_shingles FROM si GROUP BY 1)
        SELECT doc_id, item_id, count(*) AS n_shared, n_shingles,
               count(*) / n_shingles AS containment
        FROM ds JOIN si USING (s) JOIN n USING (item_id)
        GROUP BY doc_id, item_id, n_shingles HAVING 100 * count(*) >= {percent} * n_shingles"""


def near_duplicates(words: int, percent: int) -> str:
    """Components of documents whose shingle sets are similar enough."""
    return f"""
        WITH RECURSIVE d AS (SELECT doc_id, {_words(LOWERED)} AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, {_shingles(words)} AS s FROM d
              UNION SELECT doc_id, array_to_string(w, ' ') FROM d
              WHERE len(w) BETWEEN 1 AND {words - 1}),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
                  FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
                  WHERE 100 * shared >= {percent} * (x.n + y.n - shared)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM d
                  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        low AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM low LEFT JOIN n USING (doc_id)"""


def archive(least: int) -> str:
    """Pages by digest; the first of equal ones that are long enough is a response."""
    return f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
        d AS (SELECT page_id, n, sha256(html) AS digest FROM p),
        f AS (SELECT *, CASE WHEN n >= {least} THEN min(page_id) OVER (PARTITION BY digest) END AS first FROM d)
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit'
                    ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM f"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


def _merkle_levels(name: str, leaves: str) -> str:
    """Nodes of all levels over (tree, pos, h), and the steps of each leaf up to its root."""
    return f"""
        {name} AS (
            SELECT tree, 0 AS level, count(*) OVER (PARTITION BY tree) AS n, pos, h FROM {leaves}
            UNION ALL
            SELECT tree, level + 1, (n + 1) // 2, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
            FROM {name} WHERE n > 1 GROUP BY tree, level, n, pos // 2),
        {name}_steps AS (
            SELECT l.tree, l.pos,
                   list(CASE (l.pos >> v.level) & 1 WHEN 1 THEN 'L' ELSE 'R' END || coalesce(s.h, '')
                        ORDER BY v.level) AS steps
            FROM {leaves} l
            JOIN (SELECT DISTINCT tree, level FROM {name} WHERE n > 1) v ON v.tree = l.tree
            LEFT JOIN {name} s ON s.tree = l.tree AND s.level = v.level
                 AND s.pos = xor(l.pos >> v.level, CAST(1 AS BIGINT))
            GROUP BY l.tree, l.pos)"""


def merkle() -> str:
    """Trees of two over the documents of each lang and over their roots; CRC-32 bit by bit."""
    fields = {c: _field(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    leaf = " || ".join(fields.values())
    changed = " || ".join((fields | {"n_chars": _field("(CAST(n_chars AS DECIMAL(20, 0)) + 1)")}).values())
    codes = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    bit = "xor(b >> 1, CASE WHEN b & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END)"
    byte = f"list_reduce(list_concat([xor(a, c)], CAST(range(8) AS BIGINT[])), lambda b, z: {bit})"
    crc = f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda a, c: {byte}), 4294967295)"
    step = "sha256(CASE s[1] WHEN 'L' THEN s[2:] || a ELSE a || s[2:] END)"
    return f"""
        WITH RECURSIVE leaves AS (
            SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({leaf}) AS h,
                   CASE WHEN {crc} % 7 = 0 THEN sha256({changed}) END AS changed FROM documents),
        l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos
              FROM leaves),
        {_merkle_levels("nodes", "l")},
        t AS (SELECT '' AS tree, tree AS own, h, row_number() OVER (ORDER BY tree) - 1 AS pos
              FROM nodes WHERE n = 1),
        {_merkle_levels("tops", "t")},
        p AS (SELECT l.doc_id, l.h AS leaf, coalesce(l.changed, l.h) AS compared, t.h AS subroot,
                     list_concat(coalesce(a.steps, []), coalesce(b.steps, [])) AS path
              FROM l JOIN t ON t.own = l.tree
              LEFT JOIN nodes_steps a ON a.tree = l.tree AND a.pos = l.pos
              LEFT JOIN tops_steps b ON b.pos = t.pos),
        f AS (SELECT *, list_reduce(list_concat([compared], path), lambda a, s: {step}) AS folded_root,
                     (SELECT h FROM tops WHERE n = 1) AS root FROM p)
        SELECT doc_id, leaf, subroot, root,
               sha256(array_to_string(list_transform(path, lambda s: s[2:]), '')) AS proof_sha256,
               folded_root, folded_root = root AS verified
        FROM f"""
