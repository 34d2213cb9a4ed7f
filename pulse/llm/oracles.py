"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from pulse.llm.chat import END, SEP, START
from pulse.llm.mixing import ROWS_PER_SLICE, UNIT
from pulse.llm.sharding import ROWS_PER_RUN

WORDS = r"len(regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+'))"


def _jump(key: str, shards: int) -> str:
    """Jump consistent hashing over a list of ``shards`` steps; the state is [bucket, next, key]."""
    k = f"(CAST({key} AS HUGEINT) & 18446744073709551615::HUGEINT)"
    stepped = "((s[3] * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT)"
    return (f"list_reduce(list_transform(range({shards}), lambda i: [0::HUGEINT]), lambda s, i: "
            f"CASE WHEN s[2] < {shards} THEN [s[2], CAST(floor(CAST(s[2] + 1 AS DOUBLE) * (2147483648.0 / CAST(({stepped} >> 33) + 1 AS DOUBLE))) AS HUGEINT), {stepped}] "
            f"ELSE s END, [(-1)::HUGEINT, 0::HUGEINT, {k}])")


OP1 = rf"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
bytes AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b
  FROM documents),
sized AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, tab[CAST(xor(c, x) & 255 AS INT) + 1])), 4294967295) AS text_crc32
  FROM bytes, crc_table),
sharded AS (
  SELECT *, CAST(s[1] AS INT) AS shard, CAST(CASE WHEN s[2] = 8 THEN 8 ELSE s[1] END AS INT) AS grown_shard
  FROM (SELECT *, {_jump("coalesce(doc_id, 0)", 8)} AS s FROM sized)),
run AS (
  SELECT *, CAST('0x' || substr(md5(concat_ws(':', doc_id, size, text_crc32, grown_shard, shard, 0)), 1, 13) AS BIGINT)
            % ((SELECT count(*) FROM documents) // {ROWS_PER_RUN} + 1) AS run
  FROM sharded)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY run, doc_id NULLS FIRST, size, text_crc32, grown_shard) - 1 AS slot, grown_shard
FROM run
"""

OP2 = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST({WORDS.format("text")} AS BIGINT) AS size, md5(coalesce(text, '')) AS digest,
         CASE WHEN length(text) > 0 THEN 2.0::DOUBLE - (length(text) - length(translate(text, '0123456789#*$%&|<>', '')))::DOUBLE / length(text) ELSE 1.0::DOUBLE END AS quality
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
capped AS (
  SELECT *, source_size * 3.0::DOUBLE AS cap, CAST(sum(source_size) OVER () AS DOUBLE) AS everything, CAST(sum(weight) OVER () AS BIGINT) AS weights,
         coalesce(sum(source_size * 3.0::DOUBLE) OVER w, 0.0::DOUBLE) AS filled, CAST(coalesce(sum(weight) OVER w, 0) AS BIGINT) AS done
  FROM sources WINDOW w AS (ORDER BY source_size::DOUBLE / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (everything - filled) / (weights - done) AS level FROM capped),
targets AS (
  SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target
  FROM levels),
drawn AS (
  SELECT s.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
         -ln((CAST('0x' || substr(md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), digest, '0', '0')), 1, 13) AS BIGINT)::DOUBLE + 0.5) / {UNIT}) / quality AS key
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
ordered AS (
  SELECT *, target - epochs * source_size AS rest,
         CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM drawn)
SELECT doc_id, size, source, source_size, target,
       size * (epochs + CASE WHEN rest > 0 AND rest - start >= 0 AND size > 0 AND floor((rest - start) / size + 0.5) >= 1 THEN 1 ELSE 0 END) AS taken
FROM ordered
"""

OP3 = r"""
WITH split AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split),
rules(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
numbered AS (SELECT *, row_number() OVER () AS n FROM parts),
fits AS (
  SELECT n, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(rverdict, length(rhost || rpath)) AS verdict
  FROM numbered, rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM numbered LEFT JOIN fits USING (n)
"""


def _escaped(x: str) -> str:
    for old, new in (("\\", "\\\\"), ("<|", "<\\|"), ("|>", "|\\>"), ("</s>", "<\\/s>"), ("<s>", "<\\s>"), ("[INST]", "[\\INST]"),
                     ("[/INST]", "[\\/INST]"), ("<<SYS>>", "<\\<SYS>>"), ("<</SYS>>", "<\\</SYS>>")):
        x = f"replace({x}, '{old}', '{new}')"
    return x


OP7 = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum({len(START) + len(SEP) + len(END)} + length({_escaped("role")}) + length({_escaped("text")})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP11 = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM pieces, (VALUES (1), (2), (3)) AS sizes(k)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 10),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang),
parts AS (
  SELECT lang, k, phrase, f AS a, pos, array_to_string(w[1:pos], ' ') AS first_part, array_to_string(w[pos + 1:], ' ') AS last_part
  FROM f, (VALUES (1), (2)) AS places(pos) WHERE pos < k),
cuts AS (
  SELECT p.*, l.f AS l, r.f AS r, 1000000 * p.a * p.a // (l.f * r.f) AS score
  FROM parts AS p JOIN f AS l ON l.lang = p.lang AND l.phrase = p.first_part JOIN f AS r ON r.lang = p.lang AND r.phrase = p.last_part),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, pos) = 1),
held AS (
  SELECT lang, phrase, max(f) AS held
  FROM (SELECT lang, f, array_to_string(w[1:2], ' ') AS phrase FROM f WHERE k = 3 UNION ALL SELECT lang, f, array_to_string(w[2:3], ' ') FROM f WHERE k = 3)
  GROUP BY lang, phrase),
ranked AS (
  SELECT weakest.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM weakest LEFT JOIN held USING (lang, phrase) WHERE held IS NULL OR 100 * held < 50 * a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES = {"op1_sharding": OP1, "op2_mixing": OP2, "op3_url_filter": OP3, "op7_chat_format": OP7, "op11_phrases": OP11}
assert ROWS_PER_SLICE       # the slices of op2 change where rows are sorted, not their order
