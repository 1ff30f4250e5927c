"""SQL twins, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

from coldhaul.llm import chat, fim, mixing, negatives, quality, sharding, topk

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _draw(joined: str) -> str:
    return f"('0x' || substr(md5({joined}), 1, 13))::BIGINT"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op1() -> str:
    import re
    controls = "|".join(re.escape(c) for c in chat.CONTROLS)
    marks = len(chat.START) + 1 + len(chat.END)

    def escaped(column: str) -> str:
        return (f"length({column}) + length({column}) - length(replace({column}, '\\', ''))"
                f" + len(regexp_extract_all({column}, {_quoted(controls)}))")

    return f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({marks} + {escaped('role')} + length(role) - length(replace(role, chr(10), '')) + {escaped('text')})::BIGINT
    AS formatted_chars
FROM given GROUP BY conv_id"""


def op2(block: int = mixing.BLOCK) -> str:
    weights = f"[{', '.join(map(str, mixing.WEIGHTS))}]"
    share, most, n = f"{mixing.SHARE}::DOUBLE", mixing.MOST, len(mixing.WEIGHTS)
    return f"""
WITH sizes AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size FROM documents),
stats AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighted AS (SELECT *, {weights}[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {n}) + 1] AS weight FROM stats),
levels AS (SELECT *, ({share} * (sum(source_size) OVER ())::BIGINT - {most} * coalesce(sum(source_size) OVER before, 0)::BIGINT)
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS level
  FROM weighted WINDOW before AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
firsts AS (SELECT *, min(CASE WHEN level * weight <= ({most} * source_size)::DOUBLE THEN position END) OVER () AS first_fit
  FROM (SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS position FROM levels)),
goals AS (SELECT source, source_size, CASE WHEN position >= first_fit THEN least(
      (SELECT max(level) FROM firsts WHERE position = first_fit) * weight, ({most} * source_size)::DOUBLE)
    ELSE ({most} * source_size)::DOUBLE END AS target FROM firsts),
budgets AS (SELECT *, round(target)::BIGINT AS budget, ceil(source_size / {block}::DOUBLE)::BIGINT AS blocks FROM goals),
needs AS (SELECT *, (sum(budget) OVER (ORDER BY source IS NULL, source))::BIGINT AS high,
    (ceil(least(budget, source_size) / {block}::DOUBLE)
     + ceil(greatest(budget - source_size, 0) / {block}::DOUBLE))::BIGINT AS needed FROM budgets),
totals AS (SELECT sum(budget)::BIGINT AS words, ceil(sum(budget) / {block}::DOUBLE)::BIGINT + 2 * count(*) AS slots FROM needs),
points AS (SELECT i AS slot, floor((i * {mixing.INVERSE_PHI}::DOUBLE - floor(i * {mixing.INVERSE_PHI}::DOUBLE))
      * words::DOUBLE)::BIGINT AS point
  FROM (SELECT unnest(range(slots))::DOUBLE AS i, words FROM totals)),
hits AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank
  FROM points JOIN needs ON point >= high - budget AND point < high),
reached AS (SELECT source, count(*) AS n FROM hits GROUP BY source),
ranks AS (SELECT * FROM hits UNION ALL
  SELECT s.source, unnest(range(coalesce(r.n, 0), s.needed)) FROM needs s LEFT JOIN reached r
    ON s.source IS NOT DISTINCT FROM r.source WHERE coalesce(r.n, 0) < s.needed),
slots AS (SELECT r.source, rank % blocks AS block, least({block}, source_size - (rank % blocks) * {block},
      budget - (rank // blocks) * source_size - (rank % blocks) * {block}) AS words
  FROM ranks r JOIN needs s ON r.source IS NOT DISTINCT FROM s.source WHERE rank < needed),
lines AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY {_draw("'mix:' || coalesce(doc_id::VARCHAR, 'null')")},
    doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM sizes WHERE size > 0),
taken AS (SELECT l.doc_id, l.source, l.start, l.size, sum(CASE WHEN s.block IS NULL THEN 0 ELSE greatest(0, least(l.start + l.size,
      s.block * {block} + s.words) - greatest(l.start, s.block * {block})) END)::BIGINT AS taken
  FROM lines l LEFT JOIN slots s ON l.source IS NOT DISTINCT FROM s.source
    AND s.block BETWEEN l.start // {block} AND (l.start + l.size - 1) // {block}
  GROUP BY ALL),
everything AS (SELECT doc_id, source, size, coalesce(taken, 0) AS taken FROM taken
  UNION ALL SELECT doc_id, source, size, 0 FROM sizes WHERE size = 0)
SELECT e.doc_id, e.size, g.source_size, g.target, e.taken
FROM everything e JOIN goals g ON e.source IS NOT DISTINCT FROM g.source"""


def op3(shards: int = 16) -> str:
    def descend(n: int, name: str) -> tuple[str, str]:
        steps, node = [], "''"
        for level, children in enumerate(sharding._levels(sharding.layout(n, shards))):
            rows = ", ".join(f"({_quoted(p)}, {_quoted(c)}, {w}::DOUBLE)" for p, kids in children.items()
                             for c, w in kids.items())
            steps.append(f"{name}{level}(parent, child, weight) AS (VALUES {rows})")
            uniform = f"({_draw(f'''coalesce(doc_id::VARCHAR, 'null') || ':' || child''')} + 0.5::DOUBLE) / {float(2 ** 52)}::DOUBLE"
            node = (f"(SELECT arg_min(child, -ln({uniform}) / weight) FROM {name}{level} WHERE parent = {node})")
        return ", ".join(steps), f"split_part({node}, '/', 3)::INTEGER"

    now, shard = descend(shards, "now")
    then, grown = descend(shards + 1, "later")
    table = ("list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, z: "
             "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))")
    return f"""
WITH {now}, {then}, crc AS MATERIALIZED (SELECT {table} AS steps),
keyed AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS bytes, {_draw("coalesce(doc_id::VARCHAR, 'null')")} AS drawn
  FROM documents),
sums AS (SELECT doc_id, (length(bytes) // 2 + 1)::BIGINT AS size, drawn, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(length(bytes) // 2), lambda i:
      ('0x' || substr(bytes, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)
    AS text_crc32 FROM keyed, crc),
places AS (SELECT doc_id, {shard} AS shard, {grown} AS grown_shard FROM (SELECT DISTINCT doc_id FROM documents))
SELECT s.doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY drawn, s.doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM sums s JOIN places p ON s.doc_id IS NOT DISTINCT FROM p.doc_id"""


def op4(k: int = topk.K, every: int = topk.EVERY, scale: int = topk.SCALE) -> str:
    return f"""
WITH rows AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT DISTINCT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM rows q JOIN rows c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= {k}"""


def op6() -> str:
    stop = ", ".join(_quoted(w) for w in quality.stop_forms())
    checks = []
    for rule in quality.RULES:
        if rule.low is not None:
            checks.append(f"{rule.part} >= {rule.whole} * {rule.low}::DOUBLE")
        if rule.high is not None:
            checks.append(f"{rule.part} <= {rule.whole} * {rule.high}::DOUBLE")
    failed = " || ".join("CASE WHEN " + " AND ".join(
        c for c in checks if c.startswith(rule.part + " ") and f" {rule.whole} " in c) + f" THEN [] ELSE ['{rule.name}'] END"
        for rule in quality.RULES)
    return f"""
WITH split AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, {WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
starts AS (SELECT row, unnest(range(1, len(words) - 1)) AS spot, words FROM split WHERE len(words) >= 3),
windows AS (SELECT row, spot, count(*) OVER (PARTITION BY row, words[spot], words[spot + 1], words[spot + 2]) AS n FROM starts),
repeats AS (SELECT row, count(DISTINCT spot + d) AS n FROM windows, (VALUES (0), (1), (2)) v(d) WHERE n > 1 GROUP BY row),
counts AS (SELECT doc_id, len(words)::BIGINT AS n_words, list_sum(list_transform(words, lambda x: length(x)))::BIGINT AS chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(words, lambda x: x IN ({stop})))::BIGINT AS n_stop_words
  FROM split LEFT JOIN repeats r USING (row)),
named AS (SELECT *, coalesce(chars, 0)::BIGINT AS word_chars,
    n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(checks)} AS kept, array_to_string({failed}, ' ') AS failed_rules, n_lines, n_stop_words
FROM named"""


def op7(words: int = 5, threshold: float = 0.8) -> str:
    return f"""
WITH RECURSIVE split AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
texts AS (SELECT text, any_value(words) AS words, min(doc_id) AS first, count(*) AS copies FROM split
  WHERE len(words) > 0 GROUP BY text),
grams AS (SELECT DISTINCT first, array_to_string(words[spot:spot + {words - 1}], ' ') AS gram
  FROM (SELECT first, words, unnest(range(1, greatest(2, len(words) - {words - 2}))) AS spot FROM texts)),
sizes AS (SELECT first, count(*) AS n FROM grams GROUP BY first),
common AS (SELECT a.first AS a, b.first AS b, count(*) AS n FROM grams a JOIN grams b USING (gram)
  WHERE a.first <> b.first GROUP BY ALL),
links AS (SELECT a, b FROM common c JOIN sizes x ON x.first = a JOIN sizes y ON y.first = b
  WHERE c.n >= {threshold} * (x.n + y.n - c.n) - 1e-9),
reach AS (SELECT first AS a, first AS b FROM texts UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
classes AS (SELECT a AS first, min(b) AS class_id FROM reach GROUP BY a),
linked AS (SELECT a AS first, sum(copies) AS n FROM links JOIN texts ON first = b GROUP BY a)
SELECT doc_id, coalesce(class_id, doc_id) AS class_id, (coalesce(copies - 1 + coalesce(n, 0), 0))::BIGINT AS n_links,
  coalesce(copies, 1)::BIGINT AS copies
FROM split s LEFT JOIN texts t ON s.text = t.text AND len(s.words) > 0
  LEFT JOIN classes c ON c.first = t.first LEFT JOIN linked l ON l.first = t.first"""


def op11() -> str:
    n = negatives
    return f"""
WITH rows AS (SELECT vec_id, CASE WHEN vec_id % {n.SHIFTED} = 0 THEN (label + 1) % {n.CLASSES} ELSE label END AS label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * {n.SCALE})) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, v) = 1),
scores AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM rows a JOIN rows c ON a.vec_id <> c.vec_id WHERE a.vec_id % {n.EVERY} = 0),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {n.POSITIVES})
SELECT anchor_id, positive_id,
  (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id AS negative_id,
  positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND {n.LOW} * positive_score <= 100 * score AND 100 * score <= {n.HIGH} * positive_score
QUALIFY rank <= {n.NEGATIVES}"""


def op12() -> str:
    def joined(low: str, high: str) -> str:
        return f"array_to_string(units[{low} + 1:{high}], '')"

    marks = " OR ".join(f"contains(text, {_quoted(s)})" for s in (fim.PREFIX, fim.SUFFIX, fim.MIDDLE))
    draws = ", ".join(f"('0x' || substr(digest, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))
    p, s, m = (_quoted(x) for x in (fim.PREFIX, fim.SUFFIX, fim.MIDDLE))
    return f"""
WITH cut AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
    sha256('{fim.SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS digest FROM documents),
drawn AS (SELECT *, len(units)::BIGINT AS n, {draws} FROM cut),
formed AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR {marks} OR h3 % 100 >= {fim.TRANSFORMED_PERCENT} THEN 'plain'
      WHEN h4 % 100 < {fim.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, {joined('0', 'a')} AS pre, {joined('a', 'b')} AS mid, {joined('b', 'n')} AS suf FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN {p} || pre || {s} || suf || {m} || mid
    WHEN 'spm' THEN {s} || suf || {p} || pre || {m} || mid ELSE text END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts"""


ORACLE_SQL = {
    "op1_chat_formatting": op1(), "op2_mixing": op2(), "op3_sharding": op3(), "op4_exact_top_k": op4(),
    "op6_quality_rules": op6(), "op7_ngram_jaccard_join": op7(),
    "op11_hard_negatives": op11(), "op12_fill_in_middle": op12(),
}
