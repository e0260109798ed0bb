"""One named query per operator, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import brown, chat, fm_index, fp_search, hnsw, jaccard, mixing, pii, quality, repair, suffix_trees, templates, token_files
from loanloom.llm.storage import Scratch, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


@query()
def op2_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and discovered spans of personal data in every document."""
    found = pii.find_pii(table(spark, sf_dir, "documents", "doc_id", "text"), Scratch(spark, "op2"))
    names = F.array(*[F.lit(k) for k in pii.KINDS])

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")

    def count(kind: str):
        number = pii.KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] < pii.KINDS.index("id"))
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(told(base), 256).alias("base_sha256"),
                        told(F.col("spans")).alias("spans"))


@query()
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, write the shards, and read each document back through the index."""
    import public_tokenizers

    scratch = Scratch(spark, "op3")
    shards = token_files.write_shards(
        table(spark, sf_dir, "documents", "doc_id", "text"), scratch, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    found = token_files.read_documents(shards)
    return token_files.with_starts(found, shards).select("doc_id", "start", "n_tokens", "ids_crc32")


CONTROL_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


_ROLES = "(VALUES ('system', 8 + 11), ('user', 7 + 8), ('assistant', 7 + 5)) AS m(role, marks)"
_CONTROLS = r"<s>|</s>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|\[ANS\]|\[ROLE\]|\[TEXT\]|\[/ROLE\]"
OP5_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), s AS (
  SELECT t.*, marks, coalesce(lag(t.role) OVER (PARTITION BY conv_id ORDER BY turn, t.role, text), 'start') || '>' || t.role AS step
  FROM t JOIN {_ROLES} ON m.role = t.role
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(marks + length(text) + length(text) - length(replace(text, chr(92), ''))
    + 2 * len(regexp_extract_all(text, '{_CONTROLS}'))) AS BIGINT) AS formatted_chars,
  bool_and(step IN ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user')) AS valid
FROM s GROUP BY conv_id
"""


@query(OP5_SQL)
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one made of control strings; digests of what is read back."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_CONVERSATION, "conv_id bigint, turn bigint, role string, text string")
    segments = Scratch(spark, "op5").store(chat.format_conversations(turns.unionByName(extra)))
    return chat.read_conversations(segments)


_WORDS7 = ("regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
OP7_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS7.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {_WORDS7.format("coalesce(text, '')")} AS w FROM benchmark),
bw AS (
  SELECT item_id, least(10, len(w)) AS n, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i, w FROM b WHERE len(w) > 0
), win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM bw),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, unnest(generate_series(1, len(w) - n + 1)) AS i, w FROM d, lens WHERE len(w) >= n),
hits AS (
  SELECT doc_id, item_id, win.n, i FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM dw) x
  JOIN win ON win.s = x.s AND win.n = x.n
), h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY 1),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query(OP7_SQL)
def op7_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document, found through an FM-index per shard."""
    found = fm_index.contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                                   table(spark, sf_dir, "benchmark", "item_id", "text"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


@query()
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a similarity of 0.9 or more."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return jaccard.link_documents(docs, Scratch(spark, "op6"), size=3, num=90, den=100).drop("class_id")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)
), hit AS (
  SELECT doc_id, i FROM win JOIN (SELECT s, min(doc_id) AS first FROM win GROUP BY s) USING (s) WHERE doc_id > first
), gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM hit),
g AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY 1),
kept AS (
  SELECT doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS s
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d) x ANTI JOIN gone USING (doc_id, p) GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query(OP9_SQL)
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words inside 50-word windows that also start in a document with a smaller id go."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return suffix_trees.remove_repeats(docs, Scratch(spark, "op9"), window=50).drop("spans")


@query()
def op1_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return hnsw.nearest(vectors, vectors.where("vec_id % 100 = 0"), 10, Scratch(spark, "op1"))


@query()
def op4_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by its host's template."""
    found = templates.main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"), Scratch(spark, "op4"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query()
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier evidence, site posteriors and verdict of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    found = quality.judge(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), Scratch(spark, "op8"))
    return found.select("doc_id", "source", "lang", "__verdict.*")


SQL_ROUNDS = 30  # twice as many as the fit takes to stand still on the test tables


def _op10_sql() -> str:
    text = "coalesce(text, '')"
    topic = "CASE " + " ".join(f"WHEN contains({text}, '{mark}') THEN '{name}'" for name, mark in mixing.TOPICS) + " ELSE 'prose' END"
    steps, last = [], "t0"
    for d in mixing.DIMENSIONS:  # the level at which targets add up to 1 is the highest that a set of limited values gives
        steps.append(f"v_{d} AS (SELECT {d}, pow(CAST(sum(tokens) AS DOUBLE), {mixing.ALPHA}) AS weight, sum(most) AS most FROM t0 GROUP BY {d} HAVING sum(tokens) > 0)")
        steps.append(f"l_{d} AS (SELECT max((1 - coalesce(full_before, 0)) / weight_left) AS level FROM (SELECT "
                     f"sum(most) OVER (ORDER BY most / weight, {d} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS full_before, "
                     f"sum(weight) OVER (ORDER BY most / weight, {d} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left FROM v_{d}))")
        steps.append(f"a_{d} AS (SELECT {d}, least(most, level * weight) AS target FROM v_{d}, l_{d})")
    for k in range(SQL_ROUNDS):
        for d in mixing.DIMENSIONS:
            name = f"r{k}_{d}"
            steps.append(f"""{name} AS MATERIALIZED (SELECT source, lang, topic, tokens, most, least(most, CASE
  WHEN target >= fixed AND share >= most THEN share WHEN target >= fixed AND free > 0 THEN share * (target - fixed) / free
  WHEN target < fixed THEN share * target / (fixed + free) ELSE 0 END) AS share
 FROM (SELECT *, sum(CASE WHEN share >= most THEN share ELSE 0 END) OVER (PARTITION BY {d}) AS fixed,
  sum(CASE WHEN share >= most THEN 0 ELSE share END) OVER (PARTITION BY {d}) AS free FROM {last}) JOIN a_{d} USING ({d}))""")
            last = name
    return f"""
WITH d AS (
  SELECT doc_id, text, coalesce(source, '') AS source, coalesce(lang, '') AS lang, {topic} AS topic,
    len(regexp_extract_all({text}, '{mixing.WORD}')) AS tokens FROM documents
), c AS (
  SELECT source, lang, topic, CAST(sum(tokens) AS BIGINT) AS tokens FROM d GROUP BY ALL
), t0 AS (
  SELECT *, tokens / ({mixing.KEEP_TOKENS}e0 * sum(tokens) OVER ()) AS most, CAST(tokens AS DOUBLE) / sum(tokens) OVER () AS share FROM c
), {", ".join(steps)}, p AS (
  SELECT source, lang, topic, CASE WHEN tokens > 0 THEN round(least(1.0, share / most), 9) ELSE 0 END AS probability FROM {last}
)
SELECT doc_id, source, lang, topic, round(probability, 6) AS probability,
  CAST('0x' || md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5({text})))[1:13] AS BIGINT) / CAST({16**13} AS DOUBLE) < probability AS keep
FROM d JOIN p USING (source, lang, topic)
"""


@query(_op10_sql())
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling probability and draw of every document, raked to tempered marginals as far as the tokens reach."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    found = mixing.mix(docs, Scratch(spark, "op10")).select("doc_id", "__mix.*")
    return found.withColumn("probability", F.round("probability", 6))


_CRC = """
crct AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
)"""


def _crc32(key: str) -> str:
    """crc32 of an ASCII text, by the table of ``_CRC``."""
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({key}, ''), lambda x: CAST(ascii(x) AS BIGINT))), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


def _op12_sql() -> str:
    white = r"\x20\x09-\x0D"

    def option(cost: str, letter: str, state: int, line: str | None = None) -> str:
        lines = f"list_prepend({line}, s{state}.t)" if line else f"s{state}.t"
        return f"{{'c': s{state}.c + {cost}, 'a': '{letter}' || s{state}.a, 't': {lines}}}"

    def row(state: int) -> str:
        name, after = ("assistant", 3) if state == 2 else ("user", 2)
        kept = [option("3 * cut", "K", after, "role || ':' || text") if i == name[0] else option("3 * cut", "K", 1, "role || ':' || text")
                for i in (name[0], *("s" * (state == 0)))]
        when = [f"CASE WHEN NOT gone AND initial = '{i}' THEN {k} END" for i, k in zip((name[0], *("s" * (state == 0))), kept)]
        rerole = option("3 + 3 * cut", "R", after, f"'{name}:' || text")
        return (f"list_sort(list_filter([{option('4', 'D', state)}, CASE WHEN NOT gone THEN {rerole} END, {', '.join(when)}], "
                f"lambda x: x IS NOT NULL))[1] AS e{state}")

    def closed(state: int) -> str:
        name, after = ("assistant", 3) if state == 2 else ("user", 2)
        then, beyond = ("user", 2) if after == 3 else ("assistant", 3)
        one = f"{{'c': e{after}.c + 3, 'a': 'I' || e{after}.a, 't': list_prepend('{name}:', e{after}.t)}}"
        two = (f"{{'c': e{beyond}.c + 6, 'a': 'II' || e{beyond}.a, "
               f"'t': list_prepend('{name}:', list_prepend('{then}:', e{beyond}.t))}}")
        return f"list_sort([e{state}, {one}, {two}])[1] AS s{state}"

    def last(cost: int, *lines: str) -> str:
        return f"{{'c': {cost}, 'a': '{'I' * len(lines)}', 't': CAST({[f'{x}:' for x in lines]} AS VARCHAR[])}}"

    return f"""
WITH RECURSIVE {_CRC}, k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), o AS (SELECT k.* EXCLUDE (key), {_crc32("key")} % 20 AS kind FROM k, crct),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM o WHERE kind <> 0
), n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    count(*) OVER (PARTITION BY conv_id) AS size, left(role, 1) AS initial FROM d
), f AS (
  SELECT *, NOT regexp_matches(text, '[^{white}]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][{white}]*$') AS bad,
    i > 1 AND lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS broken FROM n
), g AS (SELECT *, blank OR again AS gone, CAST(bad AND NOT blank AND NOT again AS INTEGER) AS cut FROM f),
v AS (
  SELECT conv_id, size AS i, {last(0)} AS s0, {last(6, 'user', 'assistant')} AS s1, {last(3, 'assistant')} AS s2, {last(0)} AS s3
  FROM (SELECT DISTINCT conv_id, size FROM n)
  UNION ALL
  SELECT conv_id, i, {", ".join(map(closed, range(4)))} FROM (
    SELECT v.conv_id, v.i - 1 AS i, {", ".join(map(row, range(4)))} FROM v JOIN g ON v.conv_id IS NOT DISTINCT FROM g.conv_id AND v.i = g.i
  )
), a AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, CAST(sum(cut) AS BIGINT) AS truncated, count(*) FILTER (broken) AS illegal
  FROM g GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(s0.c, 0) AS BIGINT) AS cost, coalesce(s0.a, '') AS audit,
  sha256(coalesce(array_to_string(s0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN a ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN (SELECT * FROM v WHERE i = 0) w ON c.conv_id IS NOT DISTINCT FROM w.conv_id
"""


@query(_op12_sql())
def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every conversation, damaged first."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    edits, summary = repair.repair(repair.damage(turns), Scratch(spark, "op12"))
    found = summary.join(repair.digest(edits), "conv").drop("conv").withColumnRenamed("conv_id", "__conv")
    every = turns.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


OP13_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{fp_search._UPPER}', '{fp_search._LOWER}'), '{fp_search.WORD}') AS w FROM documents
), s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
b AS (
  SELECT item_id, term, CAST(count(*) AS BIGINT) AS n FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{fp_search._UPPER}', '{fp_search._LOWER}'), '{fp_search.WORD}')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)
  ) GROUP BY ALL
), t AS (
  SELECT r, doc_id, size, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS size, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM b) GROUP BY ALL
), f AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM t, s GROUP BY term, n_docs
), p AS (
  SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * size * n_docs) // n_terms)) AS part FROM t, s
), x AS (
  SELECT item_id, r, doc_id, CAST(sum(b.n * weight * part) AS BIGINT) AS score FROM b JOIN p USING (term) JOIN f USING (term) GROUP BY ALL
), y AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM y WHERE rank <= 10
"""


@query(OP13_SQL)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    docs, items = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    return fp_search.search(docs, items, 10, Scratch(spark, "op13"))


@query()
def op11_brown_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-model and plain scores of every document, learnt from six of seven."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return brown.score(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2, Scratch(spark, "op11"))
