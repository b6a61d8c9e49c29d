"""DuckDB twins of the queries that SQL can express, over the same tables."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLDED_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
PLAIN_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP6 = f"""
WITH d AS (SELECT doc_id, {FOLDED_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {FOLDED_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT n FROM bw),
hits AS (
  SELECT DISTINCT doc_id, i, sizes.n, array_to_string(w[i:i + sizes.n - 1], ' ') AS win
  FROM d, sizes, unnest(range(1, len(w) - sizes.n + 2)) AS t(i)
),
found AS (SELECT doc_id, i, hits.n, item FROM hits JOIN bw ON hits.win = bw.win AND hits.n = bw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) AS t(p) GROUP BY 1),
items AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids
  FROM found GROUP BY 1
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Unrolled dynamic programming, one relation per bucket: dp{k}(j, cost, i) is
# the least padding of the j shortest lengths in at most k buckets, i the last
# cut (the smallest among equals).
_BUCKETS, _MAX, _BUDGET = 8, 2048, 16384
_layers = ",\n".join(
    f"""dp{k} AS (
  SELECT 0 AS j, 0::HUGEINT AS cost, 0 AS i
  UNION ALL
  SELECT j, cost, i FROM (
    SELECT h.j, p.j AS i, p.cost + h.length * (h.rows - coalesce(g.rows, 0)) - (h.tokens - coalesce(g.tokens, 0)) AS cost,
      row_number() OVER (PARTITION BY h.j ORDER BY p.cost + h.length * (h.rows - coalesce(g.rows, 0)) - (h.tokens - coalesce(g.tokens, 0)), p.j) AS r
    FROM h JOIN dp{k - 1} AS p ON p.j < h.j LEFT JOIN h AS g ON g.j = p.j
  ) WHERE r = 1
)"""
    for k in range(1, _BUCKETS + 1)
)
_walk = ",\n".join(
    f"cut{k} AS (SELECT i AS j FROM dp{k} JOIN {'top' if k == _BUCKETS else f'cut{k + 1}'} USING (j) WHERE j > 0)" for k in range(_BUCKETS, 0, -1)
)
_all_cuts = " UNION ".join(["SELECT j FROM top", *[f"SELECT j FROM cut{k}" for k in range(1, _BUCKETS + 1)]])
OP1 = f"""
WITH n AS (SELECT doc_id, md5(coalesce(text, '')) AS digest, len({PLAIN_WORDS}) AS n FROM documents),
cutup AS (
  SELECT doc_id, digest, p AS piece, p * {_MAX} AS start, least({_MAX}, n - p * {_MAX}) AS length
  FROM n, unnest(range(0, greatest(1, CAST(ceil(n / {_MAX}.0) AS BIGINT)))) AS t(p)
),
hist AS (SELECT length, count(*) AS c FROM cutup WHERE length > 0 GROUP BY 1),
h AS (
  SELECT row_number() OVER (ORDER BY length) AS j, length,
    sum(c) OVER (ORDER BY length) AS rows, sum(c * length) OVER (ORDER BY length) AS tokens FROM hist
),
dp0 AS (SELECT 0 AS j, 0::HUGEINT AS cost, 0 AS i),
{_layers},
top AS (SELECT max(j) AS j FROM h),
{_walk},
ends AS (SELECT h.length AS bucket FROM h JOIN ({_all_cuts}) AS c USING (j)),
placed AS (
  SELECT doc_id, piece, start, length, (SELECT min(bucket) FROM ends WHERE bucket >= length) AS bucket,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || piece || ':' || digest) AS ord
  FROM cutup
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY ord, doc_id, piece, length) - 1 AS place,
    {_BUDGET} // bucket AS rows
  FROM placed WHERE length > 0
)
SELECT doc_id, piece, start, length, bucket, place // rows AS batch, place % rows AS slot FROM ranked
UNION ALL
SELECT doc_id, piece, start, length, NULL, NULL, NULL FROM placed WHERE length <= 0
"""

OP8 = """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d),
e AS (
  SELECT *, i = len(lines) OR CAST('0x' || substr(md5((CASE WHEN i > 1 THEN md5(lines[i - 1]) ELSE '' END) || md5(lines[i])), 1, 8) AS BIGINT) % 3 = 0 AS ends
  FROM l
),
c AS (
  SELECT doc_id, lines[i] AS line, i,
    coalesce(sum(CASE WHEN ends THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM e
),
chunks AS (SELECT doc_id, place, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk FROM c GROUP BY 1, 2),
judged AS (
  SELECT *, n >= 2 AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, place) > 1 AS gone FROM chunks
)
SELECT documents.doc_id,
  CASE WHEN documents.text IS NULL THEN NULL ELSE coalesce(j.kept, '') END AS text,
  coalesce(j.n_lines, 0) AS n_lines, coalesce(j.n_removed, 0) AS n_removed
FROM documents LEFT JOIN (
  SELECT doc_id, sum(n) AS n_lines, sum(CASE WHEN gone THEN n ELSE 0 END) AS n_removed,
    string_agg(chunk, chr(10) ORDER BY place) FILTER (NOT gone) AS kept
  FROM judged GROUP BY 1
) AS j ON documents.doc_id = j.doc_id
"""

# The audit's result follows from the damage alone: the trees only find it.
OP10 = r"""
WITH r AS (
  SELECT page_id AS key, e'WARC/1.0\r\nWARC-Type: resource\r\n'
    || CASE WHEN page_id IS NULL THEN '' ELSE 'WARC-Record-ID: <urn:page:' || page_id || e'>\r\n' END
    || CASE WHEN url IS NULL THEN '' ELSE 'WARC-Target-URI: ' || url || e'\r\n' END
    || e'WARC-Date: 2024-01-01T00:00:00Z\r\nContent-Type: text/html\r\nContent-Length: '
    || strlen(coalesce(html, '')) || e'\r\n\r\n' || coalesce(html, '') AS rec
  FROM pages
),
m AS (
  SELECT key, rec, CASE key % 50
    WHEN 7 THEN substr(rec, 1, length(rec) // 2)
      || CASE WHEN substr(rec, length(rec) // 2 + 1, 1) = '~' THEN '!' ELSE '~' END || substr(rec, length(rec) // 2 + 2)
    WHEN 19 THEN substr(rec, 1, length(rec) // 2) || repeat(' ', length(rec) - length(rec) // 2)
    WHEN 31 THEN NULL ELSE rec END AS mir
  FROM r
),
h AS (
  SELECT key, strlen(rec) + 4 AS length, sha256(rec) AS digest, strlen(mir) + 4 AS found_length, sha256(mir) AS found_digest FROM m
),
f AS (
  SELECT *, CAST('0x' || substr(md5(coalesce(CAST(key AS VARCHAR), '') || digest), 1, 8) AS BIGINT)
    % greatest(1, CAST(ceil((SELECT sum(length) FROM h) / 1048576.0) AS BIGINT)) AS file FROM h
),
o AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY file ORDER BY key, digest, length ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM f
)
SELECT file, off AS "offset", off // 65536 AS "range", key AS page_id, length, digest, found_length, found_digest,
  CASE WHEN found_digest IS NULL THEN 'missing' ELSE 'corrupt' END AS status
FROM o WHERE digest IS DISTINCT FROM found_digest
"""

OP2 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 2], ' ') END AS sh
  FROM d, unnest(range(1, greatest(len(w) - 1, 2))) AS t(i) WHERE len(w) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM common JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.other = link.a
),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP4 = f"""
WITH d AS (SELECT doc_id, {PLAIN_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM d, unnest(range(1, len(w) - 33)) AS t(i)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY s) > 1),
gone AS (SELECT DISTINCT doc_id, i + o AS p FROM rep, unnest(range(0, 35)) AS t(o)),
words AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS txt FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(txt, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

_GRID = {
    "symbols": [0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3, 0.5],
    "dup_lines": [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.8],
    "repeats": [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5],
    "upper": [0.05, 0.08, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9],
}
# Cutoffs from the mildest; a score's first level is the number it does not exceed.
_mild = {r: sorted(c, reverse=True) for r, c in _GRID.items()}
_first = ", ".join(f"len(list_filter({c}, lambda c: score['{r}'] <= c))" for r, c in _mild.items())
_failed = ", ".join(f"CASE WHEN score['{r}'] > {c}[j + 1] THEN '{r}' END" for r, c in _mild.items())
OP5 = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, {PLAIN_WORDS} AS w FROM documents),
wins AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n
  FROM d, unnest(range(1, len(w) - 1)) AS x(i)
),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat FROM wins, unnest(range(0, 3)) AS x(o) WHERE n > 1 GROUP BY 1),
ln AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^ 	-
]') GROUP BY 1
),
m AS (
  SELECT d.doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
    coalesce(n_repeat, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN ln USING (doc_id)
),
s AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN lang IS NULL THEN 'null' ELSE '=' || lang END AS stratum,
    map {{
      'symbols': CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END,
      'dup_lines': CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END,
      'repeats': CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END,
      'upper': CASE WHEN word_chars > 0 THEN n_upper / word_chars ELSE 0 END
    }} AS score FROM m
),
q AS (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY 1),
f AS (SELECT *, least({_first}) AS first_level FROM s),
tests AS (
  SELECT stratum, j, count(*) FILTER (good = 1) AS n, count(*) FILTER (good <> 1) AS n_bad,
    count(*) FILTER (good = 1 AND first_level <= j) AS k, count(*) FILTER (good <> 1 AND first_level <= j) AS bad
  FROM f JOIN q USING (doc_id), unnest(range(0, {len(next(iter(_GRID.values())))})) AS t(j) WHERE NOT base_failed GROUP BY 1, 2
),
p AS (
  SELECT *, CASE WHEN k <= n * 0.01 THEN list_sum(list_transform(range(0, k + 1), lambda i: exp(
    lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01) + (n - i) * ln(0.99)))) ELSE 1 END AS p FROM tests
),
gains AS (
  SELECT *, max(p) OVER (PARTITION BY stratum ORDER BY j) <= 0.05 / (SELECT count(DISTINCT stratum) FROM p) AS certified,
    bad / greatest(n_bad, 1) - 20.0 * k / greatest(n, 1) AS gain FROM p
),
best AS (SELECT stratum, j FROM gains WHERE certified AND gain > 0 QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY gain DESC, j) = 1),
judged AS (
  SELECT s.*, array_to_string(list_filter([{_failed}], lambda x: x IS NOT NULL), ',') AS rules FROM s LEFT JOIN best USING (stratum)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND rules = '' AS kept, rules AS failed_rules
FROM judged
"""


# crc32 of a list of bytes, by the usual table.
def _crc_entry(c: int) -> int:
    for _ in range(8):
        c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
    return c


_CRC = f"CAST({[_crc_entry(i) for i in range(256)]} AS UBIGINT[])"


def crc32(text: str) -> str:
    """SQL for the crc32 of a text whose code points lie below U+0800."""
    points = f"list_transform(string_split({text}, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)] END)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), CAST(flatten({points}) AS UBIGINT[])), lambda c, b: xor(c >> 8, {_CRC}[CAST((xor(c, b) & 255) + 1 AS BIGINT)])), CAST(4294967295 AS UBIGINT))"


# levenshtein() counts bytes: the 64 letters beyond ASCII get a byte each.
_WIDE = "".join(map(chr, range(0xC0, 0x100)))
_NARROW = (UPPER + "0123456789" + "!#$%&()*+,-./:;<=>?@[]^_{|}~")[: len(_WIDE)]
OP11 = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run
  FROM documents
),
hashed AS (SELECT run, {crc32("id || ':' || run")} AS h FROM runs WHERE len(run) >= 6),
cut AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % len(run) AS BIGINT)) || substr(run, CAST(h % len(run) AS BIGINT) + 2) ELSE run END AS word FROM hashed
),
words AS (
  SELECT word, count(*) AS n, translate(word, '{_WIDE}', '{_NARROW}') AS bytes FROM cut WHERE len(word) >= 6 GROUP BY 1 HAVING count(*) >= 5
),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM words a JOIN words b ON len(b.word) BETWEEN len(a.word) - 1 AND len(a.word) + 1 AND levenshtein(a.bytes, b.bytes) = 1
),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS r FROM near
),
formed AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * words.n THEN other END AS form, CASE WHEN other_n >= 5 * words.n THEN other_n END AS form_n
  FROM words LEFT JOIN ranked ON words.word = ranked.word AND r = 1
),
chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL
  SELECT chain.word, formed.form FROM chain JOIN formed ON chain.at = formed.word WHERE formed.form IS NOT NULL
),
ends AS (SELECT chain.word, chain.at AS root FROM chain JOIN formed ON chain.at = formed.word WHERE formed.form IS NULL)
SELECT word, form, root, CAST(n AS BIGINT) AS n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM formed JOIN ends USING (word)
"""

# A state is the cost in nine digits followed by the audit, so the least text
# is the least (cost, audit); s0 to s3 are the places of the wanted pattern.
def _plus(state: str, cost: str, edit: str) -> str:
    return f"(lpad(CAST(CAST(left({state}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({state}, 10) || '{edit}')"


_into2 = f"least({_plus('s0', '2', 'I')}, {_plus('s1', '2', 'I')})"
_c2 = f"least(s2, {_into2}, {_plus('s3', '2', 'I')})"
_c3 = f"least(s3, {_plus(f'least(s2, {_into2})', '2', 'I')})"
OP12 = rf"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fault FROM conversations
),
damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM base, unnest(range(0, CASE fault WHEN 3 THEN 2 ELSE 1 END)) AS t(copy) WHERE fault <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged
),
judged AS (
  SELECT *, left(role, 1) AS c, body = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    right(body, 1) NOT IN ('.', '!', '?') AS cut, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed
),
rows AS (SELECT *, NOT blank AND NOT again AS alive, CASE WHEN cut THEN 1 ELSE 0 END AS more FROM judged),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (alive AND cut) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY 1
),
dp AS (
  SELECT conv_id, 0 AS i, '000000000' AS s0, CAST(NULL AS VARCHAR) AS s1, CAST(NULL AS VARCHAR) AS s2, CAST(NULL AS VARCHAR) AS s3 FROM counts
  UNION ALL
  SELECT conv_id, i, {_plus('c0', '3', 'D')},
    least({_plus('c1', '3', 'D')}, CASE WHEN alive AND c = 's' THEN {_plus('c0', 'more', 'K')} END),
    least({_plus('c2', '3', 'D')}, CASE WHEN alive AND c = 'u' THEN {_plus('least(c0, c1, c3)', 'more', 'K')} END, CASE WHEN alive THEN {_plus('least(c0, c1, c3)', '2 + more', 'R')} END),
    least({_plus('c3', '3', 'D')}, CASE WHEN alive AND c = 'a' THEN {_plus('c2', 'more', 'K')} END, CASE WHEN alive THEN {_plus('c2', '2 + more', 'R')} END)
  FROM (
    SELECT rows.conv_id, rows.i, alive, more, c, s0 AS c0, s1 AS c1, {_c2} AS c2, {_c3} AS c3
    FROM dp JOIN rows ON rows.conv_id IS NOT DISTINCT FROM dp.conv_id AND rows.i = dp.i + 1
  )
),
parsed AS (
  SELECT conv_id, CAST(left(best, 9) AS BIGINT) AS cost, substr(best, 10) AS audit
  FROM (SELECT dp.conv_id, least(s0, {_c3}) AS best FROM dp JOIN counts ON dp.conv_id IS NOT DISTINCT FROM counts.conv_id AND dp.i = counts.n)
),
edits AS (
  SELECT conv_id, audit, k, substr(audit, k, 1) AS e, len(replace(substr(audit, 1, k), 'I', '')) AS i,
    len(replace(substr(audit, 1, k - 1), 'D', '')) AS place, len(replace(audit, 'D', '')) % 2 AS odd
  FROM parsed, unnest(range(1, len(audit) + 1)) AS t(k)
),
repaired AS (
  SELECT edits.conv_id, place, CASE WHEN e = 'K' THEN role WHEN place % 2 = odd THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END AS line
  FROM edits LEFT JOIN rows ON edits.conv_id IS NOT DISTINCT FROM rows.conv_id AND edits.i = rows.i WHERE e <> 'D'
),
digests AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY place)) AS digest FROM repaired GROUP BY 1)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN counts ON o.conv_id IS NOT DISTINCT FROM counts.conv_id
LEFT JOIN parsed ON o.conv_id IS NOT DISTINCT FROM parsed.conv_id
LEFT JOIN digests ON o.conv_id IS NOT DISTINCT FROM digests.conv_id
"""

ORACLE_SQL = {"op2_near_duplicates": OP2, "op4_substring_dedup": OP4, "op5_quality_rules": OP5, "op10_warc_fixity": OP10, "op1_length_buckets": OP1, "op8_line_chunks": OP8, "op6_decontaminate": OP6, "op11_spelling_variants": OP11, "op12_conversation_repair": OP12}
