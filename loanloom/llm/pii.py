r"""Personal data: base patterns, and identifiers found by bootstrapped contextual extraction.

All of it is DataFrame and SQL functions. One scan turns each document into rows of matches:
``split`` by a pattern gives the gaps and ``regexp_extract_all`` the matches, so offsets are
running sums of their lengths. The patterns start only where a run of their characters starts
(or where the previous match ended), which keeps them linear on very long runs and finds the
same matches.

Contextual extraction looks for identifier-like tokens (a digit, ``MIN_TOKEN`` characters or
more) outside base spans; numbers that the card rule has judged are none. Seeds are the base
spans, whatever their form, and keys (``KEY``: 32 or more hex characters, digits and letters),
whose form alone marks them. An instance's lexical pattern is the word before the whole of it
plus the separator between them, with digits folded. All occurrences of the patterns in the
corpus are counted, whatever follows them. On the graph of patterns and instances, a pattern's
strength is the scores of the instances that follow it against all of its occurrences, so a
common word is no pattern because some tokens follow it, and an instance's score is the noisy-or
of its patterns' strengths. A pattern needs ``MIN_SEEDS`` distinct instances that are seeds or
were accepted in an earlier round, and ``LIFT`` times the share of words that are seeds. Rounds
go on until no further instance is accepted. Instances of accepted patterns that score enough
become spans of kind ``id``; so do keys in accepted patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.storage import Scratch

KINDS = ("email", "ip", "card", "phone", "id")
ROUNDS = 50  # at most; each round but the last accepts a further instance
MIN_SEEDS = 3
LIFT = 10.0
PATTERN_SCORE = 0.6
INSTANCE_SCORE = 0.6
MIN_TOKEN = 6
KEY = r"^(?=[0-9a-fA-F]*+$)(?=[0-9]*+[a-fA-F])(?=[a-fA-F]*+[0-9]).{32,}+$"
#: A number as the card rule reads it.
_NUMBER = r"^[0-9](?:-?+[0-9]){13,}+$"

_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "id": rf'(?<![^\s"=])(?=[^\s"=0-9]*+[0-9])[^\s"=]{{{MIN_TOKEN},}}+',
}
#: A cheap test that must hold before a pattern runs.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "id": None}
_OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"


def _last(text: Column, mirrored: str) -> Column:
    """What a pattern finds at the end of a text, read backwards from there, so that long texts stay linear."""
    return F.reverse(F.regexp_extract(F.reverse(text), "^" + mirrored, 0))


def _folded(word: Column, separator: Column) -> Column:
    return F.concat(F.regexp_replace(F.lower(word), "[0-9]", "9"), F.regexp_replace(separator, r"\s++", " "))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn test."""
    def term(i: Column) -> Column:  # i counts from the right, from 0
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda s, i: s + term(i))
    return total % 10 == 0


def _passes() -> Column:
    digits = F.col("digits")
    return (
        F.when(F.col("kind") == "ip", F.col("match").rlike(_OCTETS))
        .when(F.col("kind") == "card", F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False)))
        .when(F.col("kind") == "phone", F.length(digits).between(10, 15))
        .otherwise(F.col("match").isNotNull())
    )


def matches(docs: DataFrame) -> DataFrame:
    """Rows (row, doc_id, kind, i, gap, lead, match) of every match; a document without any has one row of nulls.

    ``gap`` is the code points since the previous match of the kind, ``lead`` the last two
    words of that gap, ``row`` a number of the document's row.
    """
    text = F.col("text")
    has_digit = text.rlike("[0-9]")

    def of(kind: str) -> Column:
        pattern = F.lit(PATTERNS[kind])
        # zipped first, so that both arrays are made once per text; the gap after the last match goes
        both = F.arrays_zip(F.split(text, PATTERNS[kind], -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"))
        rows = F.transform(F.filter(both, lambda z: z["match"].isNotNull()), lambda z, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(z["gap"]).alias("gap"),
            _last(z["gap"], r'[\s"=]*+[^\s"=]*+[\s"=]*+[^\s"=]*+').alias("lead"), z["match"].alias("match")))
        need = text.contains(NEEDS[kind]) if NEEDS[kind] else F.lit(True)
        # a letter-only address is the one match that needs no digit
        return F.when(need if kind == "email" else need & has_digit, rows).otherwise(F.array().cast(
            "array<struct<kind:string,i:int,gap:int,lead:string,match:string>>"))

    rows = F.concat(*[of(k) for k in KINDS])
    tagged = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.monotonically_increasing_id())
    return tagged.select("row", "doc_id", F.explode_outer(rows).alias("m")).select("row", "doc_id", "m.*")


def _located(found: DataFrame) -> DataFrame:
    before = Window.partitionBy("row", "kind").orderBy("i")
    size = F.length("match")
    end = F.sum(F.col("gap") + size).over(before)
    # where the previous match ends right before the separator, it is the context word
    lead = F.when(F.trim("lead") == "", F.concat(F.coalesce(F.lag("match").over(before), F.lit("")), F.col("lead"))).otherwise(F.col("lead"))
    return found.select("*", end.cast("long").alias("end"), lead.alias("before")).withColumn("start", F.col("end") - size).withColumn(
        "lead", F.col("before")).drop("before")


def base_spans(located: DataFrame) -> DataFrame:
    return located.where(F.col("kind") != "id").withColumn("digits", _digits(F.col("match"))).where(_passes()).drop("digits")


def contexts(located: DataFrame, base: DataFrame) -> DataFrame:
    """Seeds, which are the base spans, and identifier-like tokens outside of them, with their lexical pattern."""
    tokens = located.where(F.col("kind") == "id").withColumn("token", F.regexp_replace("match", r"[.,;:!?)\]]+$", "")).withColumn(
        "end", F.col("start") + F.length("token"))
    here = Window.partitionBy("row").orderBy("start", "end")
    earlier = here.rowsBetween(Window.unboundedPreceding, -1)
    later = here.rowsBetween(1, Window.unboundedFollowing)
    seed = F.col("kind") != "id"
    # signs that open a token, as in "(a@b.cd", stand between the word and the span
    opened = F.regexp_replace("lead", r'(?<![^\s"=])[^\s"=\p{L}\p{N}]+$', "")
    columns = ["row", "doc_id", "kind", "start", "end", "lead", "token"]
    both = tokens.select(columns).unionByName(base.withColumn("lead", opened).withColumn("token", F.col("match")).select(columns))
    marked = both.withColumn("past", F.max(F.when(seed, F.col("end"))).over(earlier)).withColumn(
        "next", F.min(F.when(seed, F.col("start"))).over(later))
    separator = _last(F.col("lead"), r'[\s"=]*+')
    rest = F.left("lead", F.length("lead") - F.length(separator))
    pattern = _folded(_last(rest, r'[^\s"=]*+'), separator)
    outside = ~F.coalesce((F.col("past") > F.col("start")) | (F.col("next") < F.col("end")), F.lit(False))
    return (
        marked.where(seed | outside & (F.length("token") >= MIN_TOKEN) & ~F.col("token").rlike(_NUMBER))
        .select("row", "doc_id", "start", "end", seed.alias("base"), (seed | F.col("token").rlike(KEY)).alias("seed"), pattern.alias("pattern"), F.xxhash64(F.lower("token")).alias("instance"))
        .where(F.trim("pattern") != "")
    )


def occurrences(docs: DataFrame) -> DataFrame:
    """(pattern, total): every word and the separator after it in the running text, counted."""
    pairs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r'(?<![^\s"=])[^\s"=]++[\s"=]++'), F.lit(0))
    pair = docs.select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("total"))
    word = F.regexp_extract("pair", r'^[^\s"=]++', 0)
    separator = F.substring("pair", F.length(word) + 1, F.length("pair"))
    return pair.groupBy(_folded(word, separator).alias("pattern")).agg(F.sum("total").alias("total"))


def score(edges: DataFrame, totals: DataFrame, scratch: Scratch) -> DataFrame:
    """Iterate over edges (pattern, instance, n, seed) and all occurrences (pattern, total); returns
    (pattern, instance) of accepted patterns and instances, with the pattern's ``strength``.

    A pattern without a separator is in no total and counts by its own edges.
    """
    seeds = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("score"))
    words = totals.agg(F.sum("total")).first()[0] or 0
    floor = LIFT * (edges.where("seed").agg(F.sum("n")).first()[0] or 0) / max(1, words)
    own = edges.groupBy("pattern").agg(F.sum("n").alias("n"))
    base = scratch.store(own.join(totals, "pattern", "left").select(
        "pattern", F.greatest("n", F.coalesce("total", F.lit(0))).alias("total")))
    scored, before = scratch.store(seeds.withColumn("accepted", F.col("score") == 1)), -1
    for _ in range(ROUNDS):
        followed = edges.join(scored, "instance").groupBy("pattern").agg(
            F.sum(F.col("score") * F.col("n")).alias("good"), F.sum(F.col("accepted").cast("long")).alias("support")).where(F.col("support") >= MIN_SEEDS)
        strength = F.col("good") / (F.col("total") + 1)
        patterns = scratch.store(followed.join(base, "pattern").select("pattern", strength.alias("strength")).where(
            F.col("strength") >= F.least(F.lit(floor), F.lit(PATTERN_SCORE))))
        reach = edges.join(patterns, "pattern").groupBy("instance").agg(
            (1 - F.exp(F.sum(F.log1p(-F.col("strength"))))).alias("reached"), F.max("strength").alias("best"))
        known = F.col("score") == 1
        new = scratch.store(seeds.join(reach, "instance", "left").select(
            "instance", F.greatest("score", F.coalesce("reached", F.lit(0.0))).alias("score"),
            (known | F.coalesce((F.col("reached") >= INSTANCE_SCORE) & (F.col("best") >= PATTERN_SCORE), F.lit(False))).alias("accepted")))
        scratch.drop(scored)
        scored, found = new, new.where("accepted").count()
        if found == before:
            break
        before = found
    good = patterns.where(F.col("strength") >= PATTERN_SCORE)
    return edges.select("pattern", "instance").join(good, "pattern").join(scored.where("accepted").select("instance"), "instance")


def find_pii(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """All spans of ``docs`` (doc_id, text): one row per document row with ``spans``, an array of
    (start, kind number, end) in order, kinds as in ``KINDS``.

    Offsets are code points. Null and empty texts have no spans; repeated rows repeat.
    """
    found = scratch.store(matches(docs))
    located = scratch.store(_located(found.where("match IS NOT NULL")))
    base = base_spans(located)
    tokens = scratch.store(contexts(located, base))
    edges = scratch.store(tokens.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n")))
    new = tokens.where(~F.col("base")).join(score(edges, scratch.store(occurrences(docs)), scratch), ["pattern", "instance"]).select(
        "row", "doc_id", F.lit("id").alias("kind"), "start", "end")
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    span = F.struct(F.col("start"), number.alias("kind"), F.col("end"))
    every = base.select("row", "doc_id", "kind", "start", "end").unionByName(new).select("row", "doc_id", span.alias("span"))
    every = every.unionByName(found.where("match IS NULL").select("row", "doc_id"), allowMissingColumns=True)
    # documents whose matches all failed are in no branch above
    every = every.unionByName(found.where("i = 0").select("row", "doc_id"), allowMissingColumns=True)
    return every.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list("span")).alias("spans")).drop("row")
