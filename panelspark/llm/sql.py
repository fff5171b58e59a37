"""Equivalent DuckDB SQL of those queries that SQL can express."""

from __future__ import annotations

WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_dedup(source: str = "documents", min_chars: int = 20, min_docs: int = 3) -> str:
    """Rows: doc_id, n_lines, n_dropped, kept (the remaining text)."""
    return f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM {source}),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM cut),
keyed AS (SELECT *, translate(trim(line, {WHITE}), '{UPPER}', '{LOWER}') AS k FROM lines),
repeated AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= {min_chars} GROUP BY k
             HAVING count(DISTINCT doc_id) >= {min_docs}),
marked AS (SELECT keyed.*, coalesce(doc_id < keeper, false) AS gone FROM keyed LEFT JOIN repeated USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
FROM marked GROUP BY doc_id"""


LINE_DEDUP = f"SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM ({line_dedup()})"

# Checksum of the text: the table follows from the polynomial, bytes come from the hex form.
CRC_TABLE = ("list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], "
             "lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))")
CRC = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all("
       "hex(encode(coalesce(text, ''))), '..'), lambda p: 16 * (instr('123456789ABCDEF', p[1])) "
       "+ instr('123456789ABCDEF', p[2]))), lambda c, b: xor(c // 256, steps[xor(c, b) % 256 + 1])))")


def _hilbert(bits: int, axes: list[str], frame: str) -> str:
    """Nested selects that turn the axes into the curve index, step by step."""
    first = axes[0]

    def step(frame: str, changed: dict[str, str]) -> str:
        kept = ", ".join(f"{changed.get(a, a)} AS {a}" for a in axes)
        return f"(SELECT * EXCLUDE ({', '.join(axes)}), {kept} FROM {frame})"

    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for a in axes:
            swap = f"(xor({first}, {a}) & {low})"
            changed = {first: f"CASE WHEN {a} & {bit} != 0 THEN xor({first}, {low}) ELSE xor({first}, {swap}) END"}
            if a != first:
                changed[a] = f"CASE WHEN {a} & {bit} != 0 THEN {a} ELSE xor({a}, {swap}) END"
            frame = step(frame, changed)
    for before, a in zip(axes, axes[1:]):
        frame = step(frame, {a: f"xor({a}, {before})"})
    flip = "0"
    for level in range(bits - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN {axes[-1]} & {1 << level} != 0 THEN {(1 << level) - 1} ELSE 0 END)"
    frame = f"(SELECT *, {flip} AS flip FROM {frame})"
    index = "0"
    for level in range(bits - 1, -1, -1):
        for a in axes:
            index = f"({index} * 2 + ((xor({a}, flip) >> {level}) & 1))"
    return f"(SELECT *, CAST({index} AS BIGINT) AS curve FROM {frame})"


def hilbert_sharding(shards: int, bits: int = 5) -> str:
    axes = {"a0": "source", "a1": "lang", "a2": "size"}
    steps = ", ".join(f"CAST((rank() OVER (ORDER BY {c} NULLS FIRST) - 1) * {2 ** bits} // count(*) OVER () AS BIGINT) "
                      f"AS {a}" for a, c in axes.items())
    return f"""
WITH sized AS (SELECT doc_id, lang, source, strlen(coalesce(text, '')) + 8 AS size, md5(coalesce(text, '')) AS m,
                      CAST({CRC} AS BIGINT) AS text_crc32 FROM documents, (SELECT {CRC_TABLE} AS steps)),
axes AS (SELECT *, {steps} FROM sized),
placed AS (SELECT *, row_number() OVER (ORDER BY curve, m, doc_id NULLS FIRST) - 1 AS place, count(*) OVER () AS n
           FROM {_hilbert(bits, list(axes), 'axes')}),
cut AS (SELECT *, place * {shards} // n AS s FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(s AS INTEGER) AS shard,
       place - (s * n + {shards - 1}) // {shards} AS slot, CAST(NULL AS INTEGER) AS grown_shard, curve
FROM cut"""


def collocations(source: str = "documents", min_count: int = 100, top: int = 2000) -> str:
    """Phrases by plain enumeration of every start in every piece."""
    return f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                       unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                                 '[.,;:!?\\x0A-\\x0D]')) AS piece FROM {source}),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces),
starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS s FROM cut),
grams AS (SELECT lang, k, array_to_string(words[s:s + k - 1], ' ') AS phrase
          FROM starts, range(1, 6) AS sizes(k) WHERE s + k - 1 <= len(words)),
totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY lang),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {min_count}),
cuts AS (SELECT *, unnest(range(1, k)) AS c FROM counts WHERE k >= 2),
sides AS (SELECT *, array_to_string(string_split(phrase, ' ')[:c], ' ') AS first,
                 array_to_string(string_split(phrase, ' ')[c + 1:], ' ') AS rest FROM cuts),
scored AS (SELECT s.lang, s.k, s.phrase, s.f AS a, s.c, p.f AS l, q.f AS r, t.n,
                  CAST((1000::HUGEINT * s.f * t.n) // (p.f::HUGEINT * q.f) AS BIGINT) AS score
           FROM sides s JOIN counts p ON p.lang = s.lang AND p.phrase = s.first
           JOIN counts q ON q.lang = s.lang AND q.phrase = s.rest JOIN totals t ON t.lang = s.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
kept AS (SELECT b.* FROM best b WHERE NOT EXISTS (
             SELECT 1 FROM counts o WHERE o.lang = b.lang AND o.k > b.k AND 100 * o.f >= 100 * b.a
             AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= {top}"""


def lexical_search(docs: str = "documents", items: str = "benchmark", size: int = 10) -> str:
    """Every document scored for every item that shares a term with it."""
    found = ("regexp_extract_all(translate(coalesce(text, ''), '{0}', '{1}'), "
             "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')").format(UPPER, LOWER)
    return f"""
WITH cut AS (SELECT doc_id, {found} AS terms FROM {docs}),
sized AS (SELECT row_number() OVER () AS d, doc_id, terms, len(terms) AS n FROM cut WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS total, CAST(sum(n) AS BIGINT) AS length FROM sized),
postings AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM sized) GROUP BY d, term),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(total) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE)))
                   AS BIGINT) AS w FROM postings, corpus GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest({found}) AS term FROM {items}),
impacts AS (SELECT term, s.doc_id, s.d, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * total) // length))) AS i
            FROM postings JOIN weights USING (term) JOIN sized s USING (d), corpus),
scored AS (SELECT item_id, d, any_value(doc_id) AS doc_id, CAST(sum(i) AS BIGINT) AS score
           FROM asked JOIN impacts USING (term) GROUP BY item_id, d HAVING sum(i) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored QUALIFY rank <= {size}"""
