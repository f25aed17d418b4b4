"""SQL that DuckDB can run for the queries that SQL expresses.

``op1`` and ``op3`` fit models and ``op10`` encodes with a vocabulary file; SQL cannot express those.
"""

from __future__ import annotations

from vulnlake.llm import decontamination as D
from vulnlake.llm import license_scan as L
from vulnlake.llm import quality_rules as R

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _crc_step(value: str, times: int = 8) -> str:
    return value if not times else _crc_step(f"list_transform({value}, lambda x: CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END)", times - 1)


def shards(n: int = 40, seed: str = "shard") -> str:
    return rf"""
    WITH crc AS (SELECT {_crc_step("range(256)")} AS steps),
    raw AS (
      SELECT doc_id, source, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS digits,
        (('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12))::BIGINT) / 281474976710656.0 AS f
      FROM documents
    ),
    d AS (
      SELECT doc_id, source, CAST(length(digits) // 2 + 16 AS BIGINT) AS size, f,
        CAST(xor(4294967295, list_reduce(
          list_transform(range(1, length(digits), 2), lambda i: ('0x' || substr(digits, i, 2))::BIGINT),
          lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295)) AS BIGINT) AS text_crc32
      FROM raw, crc
    ),
    inside AS (
      SELECT *, (row_number() OVER (PARTITION BY source ORDER BY f, doc_id, text_crc32, size) - 1 + 0.5::DOUBLE) / count(*) OVER (PARTITION BY source) AS share
      FROM d
    ),
    placed AS (
      SELECT *, row_number() OVER (ORDER BY share, source NULLS FIRST, doc_id, text_crc32, size) - 1 AS place, count(*) OVER () AS n FROM inside
    ),
    cut AS (SELECT *, n // {n} AS per, n % {n} AS rest, (n % {n}) * (n // {n} + 1) AS wide FROM placed)
    SELECT doc_id, size, text_crc32, 'rows' AS law,
      CAST(CASE WHEN place < wide THEN place // (per + 1) ELSE rest + (place - wide) // greatest(per, 1) END AS INTEGER) AS shard,
      CAST(CASE WHEN place < wide THEN place % (per + 1) ELSE (place - wide) % greatest(per, 1) END AS BIGINT) AS slot,
      CAST(NULL AS INTEGER) AS grown_shard, source
    FROM cut
    """


EXACT = rf"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACE}+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d
"""

PREFERENCES = """
WITH base AS (SELECT conv_id AS pair_id, coalesce(turn, -1) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT pair_id, max(turn) AS last FROM base WHERE role = 'assistant' GROUP BY 1),
sides AS (
  SELECT pair_id, 'chosen' AS side, turn, role, text FROM base
  UNION ALL
  SELECT pair_id, 'rejected', turn, role,
    CASE WHEN role = 'assistant' AND turn = last THEN array_to_string(list_reverse(string_split(text, ' ')), ' ') ELSE text END
  FROM base LEFT JOIN last USING (pair_id)
),
placed AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) - 1 AS place FROM sides),
met AS (
  SELECT pair_id, place, count(*) = 2 AND min(role) = max(role) AND min(text) = max(text) AS same FROM placed GROUP BY 1, 2
),
shared AS (SELECT pair_id, coalesce(min(place) FILTER (WHERE NOT same), max(place) + 1) AS shared FROM met GROUP BY 1),
parts AS (
  SELECT *, CASE WHEN place < shared THEN 'prompt' ELSE side END AS part, '<|im_start|>' || role || chr(10) AS head,
    '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS segment,
    CASE WHEN place < shared THEN place ELSE place - shared END AS seq
  FROM placed JOIN shared USING (pair_id) WHERE side = 'chosen' OR place >= shared
),
laid AS (
  SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY pair_id, part ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM parts
)
SELECT pair_id, part, CAST(seq AS BIGINT) AS seq, role, segment, CAST(start AS BIGINT) AS start, CAST(start + length(segment) AS BIGINT) AS end,
  CASE WHEN role = 'assistant' AND part <> 'prompt' THEN CAST(start + length(head) AS BIGINT) END AS trained_start,
  CASE WHEN role = 'assistant' AND part <> 'prompt' THEN CAST(start + length(segment) - 1 AS BIGINT) END AS trained_end
FROM laid
"""


def licenses() -> str:
    rows = [f"({n}, '{label}', {str(n < len(L.PHRASES)).lower()}, '{text.replace(chr(39), chr(39) * 2)}')" for n, (label, text) in enumerate([*L.PHRASES, *L.TEMPLATES])]
    words = lambda c: f"regexp_extract_all(translate({c}, '{UPPER}', '{LOWER}'), '{LICENSE_WORD}')"
    grams = lambda c: f"list_transform(range(1, len({c}) - {L.GRAM - 2}), lambda i: array_to_string(list_slice({c}, i, i + {L.GRAM - 1}), ' '))"
    telling = lambda c: f"list_sort(list_filter({c}, lambda x: regexp_full_match(x, '[0-9]+|{'|'.join(L.FAMILY)}')))"
    return rf"""
    WITH t(template, label, phrase, text) AS (VALUES {", ".join(rows)}),
    tw AS (SELECT template, label, phrase, {words("text")} AS w FROM t),
    tt AS (SELECT template, label, phrase, len(w) AS size, {telling("w")} AS telling, w FROM tw),
    tg AS (SELECT template, unnest({grams("w")}) AS gram, generate_subscripts({grams("w")}, 1) - 1 AS place FROM tt),
    dw AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {words("coalesce(text, '')")} AS w FROM documents),
    dg AS (SELECT row, unnest({grams("w")}) AS gram, generate_subscripts({grams("w")}, 1) - 1 AS pos FROM dw WHERE len(w) >= {L.GRAM}),
    voted AS (SELECT row, template, pos - place AS diagonal, list(place) AS places FROM dg JOIN tg USING (gram) GROUP BY ALL),
    marked AS (
      SELECT voted.*, label, phrase, size, telling,
        CASE WHEN phrase THEN 1 WHEN coalesce(diagonal - lag(diagonal) OVER (PARTITION BY row, template ORDER BY diagonal) <= {L.NEAR}, false) THEN 0 ELSE 1 END AS new
      FROM voted JOIN tt USING (template)
    ),
    numbered AS (SELECT *, sum(new) OVER (PARTITION BY row, template ORDER BY diagonal) AS span FROM marked),
    held AS (
      SELECT row, template, label, phrase, size, telling, span, unnest(places) AS place, diagonal FROM numbered
    ),
    spans AS (
      SELECT row, template, label, phrase, size, telling, span, count(*) AS votes, min(place + diagonal) AS first, max(place + diagonal) + {L.GRAM} AS last,
        len(list_distinct(flatten(list([place, place + 1, place + 2])))) AS covered,
        len(list_distinct(flatten(list([place + diagonal, place + diagonal + 1, place + diagonal + 2])))) AS own
      FROM held GROUP BY ALL
    ),
    judged AS (
      SELECT spans.*, covered::DOUBLE / size AS coverage, greatest(1, size // {L.WORDS_PER_EDIT}) AS edits,
        CASE WHEN phrase THEN votes = size - {L.GRAM - 1}
          ELSE size - covered <= {L.GRAM} * edits AND last - first - own <= edits AND {telling("list_slice(w, first + 1, last)")} = telling END AS found
      FROM spans JOIN dw USING (row)
    ),
    summed AS (
      SELECT row, count(*) FILTER (WHERE phrase AND found) AS n_base, min(first) FILTER (WHERE phrase AND found) AS first_word,
        max(first) FILTER (WHERE phrase AND found) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE phrase AND found) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE found) AS labels, max(coverage) FILTER (WHERE found) AS score,
        count(*) FILTER (WHERE found) AS n_spans
      FROM judged GROUP BY row
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
      coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0.0) AS DOUBLE) AS score, coalesce(n_spans, 0) AS n_spans
    FROM dw LEFT JOIN summed USING (row)
    """


WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS origin FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> origin THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> origin THEN origin END AS refers_to
FROM g
"""


def rules() -> str:
    bits = " + ".join(f"CASE WHEN {rule} THEN {1 << k} ELSE 0 END" for k, rule in enumerate(R.RULES.values()))
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
    counted AS (
      SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY 1
    ),
    win AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM d WHERE len(w) >= 8),
    keyed AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS key FROM win),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, key) AS n FROM keyed) WHERE n > 1),
    hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(8) AS r(k) GROUP BY 1),
    m AS (
      SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '{SPACE}', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN hit USING (doc_id)
    ),
    b AS (SELECT *, CAST({bits} AS BIGINT) AS bits FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bits & {R.mask(R.POLICIES[1])} <> 0 AS base_failed,
      bits & {R.mask(R.POLICIES[max(R.POLICIES)])} = 0 AS kept, bits
    FROM b
    """


NEAR = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' ')) END) AS g
  FROM d
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON l.a = r.b),
low AS (SELECT a AS doc_id, least(a, min(b)) AS root FROM reach GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(root, doc_id) AS component_id, coalesce(root, doc_id) = doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""

def merkle(levels: int = 7, arity: int = 16) -> str:
    """The manifest with its levels written out: trees of up to ``arity ** levels`` leaves."""
    field = lambda c: f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    crc = (
        "xor(4294967295, list_reduce(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), "
        "lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT)), "
        "lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295))"
    )

    def climb(name: str) -> str:
        parts = []
        for k in range(levels):
            parts.append(f"""{name}{k + 1} AS (
              SELECT tree, idx // {arity} AS idx, any_value(size) AS width, array_agg(digest ORDER BY idx) AS kids,
                CASE WHEN any_value(size) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest,
                CAST((any_value(size) + {arity - 1}) // {arity} AS BIGINT) AS size
              FROM {name}{k} GROUP BY tree, idx // {arity}
            )""")
        return ", ".join(parts)

    def sides(name: str, idx: str) -> tuple[str, list[tuple[str, str]]]:
        joins, out = [], []
        for k in range(levels):
            alias, slot = f"{name}_{k}", f"(({idx} // {arity**k}) % {arity})"
            joins.append(f"JOIN {name}{k + 1} {alias} ON {alias}.tree = {name}_tree AND {alias}.idx = {idx} // {arity ** (k + 1)}")
            left = f"CASE WHEN {alias}.width = 1 THEN '' ELSE array_to_string({alias}.kids[1:{slot}], '') END"
            right = f"CASE WHEN {alias}.width = 1 THEN '' ELSE array_to_string({alias}.kids[{slot} + 2:], '') END"
            out.append((f"{alias}.width", left, right))
        return " ".join(joins), out

    lower_joins, lower = sides("a", "leaf_idx")
    upper_joins, upper = sides("u", "a_tree")
    folds, h = [], "start"
    for k, (width, left, right) in enumerate([*lower, *upper]):
        folds.append(f"f{k} AS (SELECT *, CASE WHEN w{k} = 1 THEN {h} ELSE sha256(l{k} || {h} || r{k}) END AS h{k} FROM {f'f{k - 1}' if k else 'paths'})")
        h = f"h{k}"
    named = ", ".join(f"{w} AS w{k}, {a} AS l{k}, {b} AS r{k}" for k, (w, a, b) in enumerate([*lower, *upper]))
    proof = " || ".join(f"l{k} || r{k}" for k in range(2 * levels))
    return rf"""
    WITH crc AS (SELECT {_crc_step("range(256)")} AS steps),
    d AS (
      SELECT doc_id, source, sha256({head} || {field("text")}) AS leaf,
        CASE WHEN coalesce({crc} % 5 = 0, false) THEN sha256({head} || {field(f"translate(text, '{UPPER}', '{LOWER}')")}) END AS probe
      FROM documents, crc
    ),
    trees AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS size FROM d GROUP BY source),
    a0 AS (
      SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, leaf AS digest, CAST(size AS BIGINT) AS size, doc_id, probe
      FROM d JOIN trees ON d.source IS NOT DISTINCT FROM trees.source
    ),
    {climb("a")},
    u0 AS (SELECT 0 AS tree, tree AS idx, digest, (SELECT count(*) FROM trees) AS size FROM a{levels}),
    {climb("u")},
    leaves AS (SELECT doc_id, digest AS leaf, coalesce(probe, digest) AS start, tree AS a_tree, 0 AS u_tree, idx AS leaf_idx FROM a0),
    paths AS (
      SELECT doc_id, leaf, start, u0.digest AS subroot, u{levels}.digest AS root, {named}
      FROM leaves {lower_joins} {upper_joins} JOIN u0 ON u0.idx = a_tree JOIN u{levels} ON true
    ),
    {", ".join(folds)}
    SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, {h} AS folded_root, {h} = root AS verified FROM f{2 * levels - 1}
    """


def contamination() -> str:
    words = lambda c: f"regexp_extract_all(translate(coalesce({c}, ''), '{UPPER}', '{LOWER}'), '{LICENSE_WORD}')"
    return rf"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {words("text")} AS w FROM documents),
    b AS (SELECT item_id, {words("text")} AS w FROM benchmark),
    p AS (
      SELECT DISTINCT item_id, unnest(list_transform(range(1, greatest(len(w) - {D.SIZE - 1}, 1) + 1), lambda i: list_slice(w, i, i + {D.SIZE - 1}))) AS phrase
      FROM b WHERE len(w) > 0
    ),
    q AS MATERIALIZED (SELECT row_number() OVER () AS q, phrase, len(phrase) AS n FROM (SELECT DISTINCT phrase FROM p)),
    t AS MATERIALIZED (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS pos, len(w) AS n_words FROM d),
    c AS (SELECT word, count(*) AS n FROM t GROUP BY word),
    qt AS MATERIALIZED (SELECT q, n, unnest(phrase) AS word, generate_subscripts(phrase, 1) AS place FROM q),
    anchor AS (
      SELECT q, n, word, place FROM (SELECT qt.*, row_number() OVER (PARTITION BY q ORDER BY coalesce(c.n, 0), place) AS rank FROM qt LEFT JOIN c USING (word)) WHERE rank = 1
    ),
    candidate AS MATERIALIZED (
      SELECT q, n, row, pos - place AS start, row_number() OVER () AS id FROM anchor JOIN t USING (word)
    ),
    seen AS (
      SELECT id, count(DISTINCT place) AS close, count(DISTINCT place) FILTER (WHERE pos = start + place) AS there
      FROM candidate JOIN qt USING (q) JOIN t ON t.row = candidate.row AND t.word = qt.word AND t.pos BETWEEN start + place - {D.SLOP} AND start + place + {D.SLOP}
      GROUP BY id
    ),
    met AS (SELECT row, q, start, n, there = n AS exact FROM candidate JOIN seen USING (id) WHERE close = n),
    hit AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(start, start + n)) AS place FROM met WHERE exact) GROUP BY row),
    listed AS (
      SELECT row, string_agg(DISTINCT item, ',' ORDER BY item) FILTER (WHERE exact) AS items, count(DISTINCT item) FILTER (WHERE exact) AS n_items, count(DISTINCT item) AS n_near
      FROM (SELECT row, exact, CAST(item_id AS VARCHAR) AS item FROM met JOIN q USING (q) JOIN p USING (phrase)) GROUP BY row
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
    FROM d LEFT JOIN hit USING (row) LEFT JOIN listed USING (row)
    """


SQL: dict[str, str] = {
    "op2_interleaved_shards": shards(),
    "op4_digest_index": EXACT,
    "op5_preference_format": PREFERENCES,
    "op6_diagonal_votes": licenses(),
    "op7_gzip_normaliser": WARC,
    "op8_rule_ledger": rules(),
    "op9_super_minhash": NEAR,
    "op12_sibling_shift_manifest": merkle(),
    "op13_positional_index": contamination(),
}
