"""Mixing sources to target weights by iterative proportional fitting.

Token counts per (source, language, topic) cell are raked to the three target marginals in
turn; a cell's fitted share against its share of the corpus gives the probability with which
its documents are sampled. No probability exceeds 1: a cell that would is fixed at 1, and the
others of the same marginal are raked to what is left of its target. A marginal that asks for
more tokens of a value than the corpus holds gets all of them, and the rest of it goes to the
other values in proportion to their targets (``feasible``). Rounds go on until no share moves.

The cell table is small next to the corpus. Up to ``BROADCAST_CELLS`` counted cells are raked in
one task, a step being a window by one dimension; more stay distributed: a step is an aggregate by one
dimension joined back to the cells. A document's draw is a hash of its id, so the sample
does not depend on partitioning or retries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from loanloom.llm.storage import Scratch

DIMENSIONS = ("source", "lang", "topic")
ROUNDS = 200  # at most, for targets that contradict each other; others stop at TOLERANCE, after 12 to 14 rounds on the test tables
TOLERANCE = 1e-10
KEEP_TOKENS = 0.5
ALPHA = 0.5
SEED = "mix"
BROADCAST_CELLS = 50_000
#: Topic by the first mark that a text contains.
TOPICS = (("contact", "@"), ("legal", "Licensed under"), ("tabular", " | "))
WORD = r"[^\x20\x09-\x0D]+"


def topic(text: Column, rules: tuple[tuple[str, str], ...] = TOPICS) -> Column:
    out = F.lit("prose")
    for name, mark in reversed(rules):
        out = F.when(text.contains(mark), F.lit(name)).otherwise(out)
    return out


def cell(docs: DataFrame) -> list[Column]:
    """The document's cell; missing values are the value ""."""
    return [F.coalesce(F.col("source"), F.lit("")).alias("source"), F.coalesce(F.col("lang"), F.lit("")).alias("lang"),
            topic(F.coalesce(F.col("text"), F.lit(""))).alias("topic")]


def draw(key: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the hash of a key; without a key, from that of the text."""
    known = F.coalesce(key.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), known)), 1, 13), 16, 10).cast("double") / float(16**13)


def feasible(cells: DataFrame, dimension: str, scratch: Scratch, given: dict[str, float] | None = None, alpha: float = ALPHA) -> DataFrame:
    """Targets of a dimension's values: (dimension, asked, most, target), as shares of the sample.

    ``cells`` hold ``tokens`` and ``most``, the share of the sample if all of a cell is kept. Values ask for
    their ``given`` weight (others for none), else for their tokens to the power ``alpha``. The target is
    least(most, level * asked) with the level at which targets add up to 1; where even all tokens of the values
    asked for do not, they are the targets.
    """
    own = cells.groupBy(dimension).agg(F.sum("tokens").cast("double").alias("tokens"), F.sum("most").alias("most"))
    if given:
        weight = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in given.items() for x in kv]), F.col(dimension)), F.lit(0.0))
    else:
        weight = F.pow("tokens", F.lit(alpha))
    values = scratch.store(own.select(dimension, F.when(F.col("tokens") > 0, weight).otherwise(F.lit(0.0)).cast("double").alias("weight"), "most"))
    level = None
    while True:  # each pass fixes at least one more value that its tokens limit
        limited = F.col("weight") * F.lit(level) >= F.col("most") if level else F.lit(False)
        full, left, weights = values.where("weight > 0").agg(
            F.sum(F.when(limited, F.col("most")).otherwise(0.0)), F.sum(F.when(limited, 0.0).otherwise(F.col("weight"))), F.sum("weight")).first()
        if not left:
            level = float("inf") if weights else None
            break
        new = (1.0 - full) / left
        if level is not None and new <= level:
            break
        level = new
    scale = F.lit(1.0 / weights if weights else 0.0)
    target = F.when(F.col("weight") > 0, F.least(F.col("most"), F.lit(level).cast("double") * F.col("weight"))).otherwise(F.lit(0.0))
    return scratch.store(values.select(dimension, (F.col("weight") * scale).alias("asked"), "most", target.alias("target")))


def _step(cells: DataFrame, dimension: str, whole: bool, small: bool) -> DataFrame:
    """One marginal: cells at their most are fixed, the others share what is left of the target (in ``to_<dimension>``).

    Cells that are ``whole`` in one partition take their sums from a window, so a round's plan reads them once;
    by a join each of its three steps would hold the plan of the steps before twice. Sums of a ``small`` dimension
    are broadcast.
    """
    at_most = F.col("share") >= F.col("most")
    full, free = (F.sum(x) for x in (F.when(at_most, F.col("share")).otherwise(0.0), F.when(at_most, 0.0).otherwise(F.col("share"))))
    if whole:
        own = Window.partitionBy(dimension)
        both = cells.select("*", full.over(own).alias("full"), free.over(own).alias("free"))
    else:
        sums = cells.groupBy(dimension).agg(full.alias("full"), free.alias("free"))
        both = cells.join(F.broadcast(sums) if small else sums, dimension)
    target = F.col(f"to_{dimension}")
    left, total = target - F.col("full"), F.col("full") + F.col("free")
    raked = (
        F.when((left >= 0) & at_most, F.col("share"))
        .when((left >= 0) & (F.col("free") > 0), F.col("share") * left / F.col("free"))
        .when((left < 0) & (total > 0), F.col("share") * target / total)
        .otherwise(F.lit(0.0))
    )
    return both.withColumn("share", F.least(F.col("most"), raked)).select(cells.columns)


def rake(cells: DataFrame, scratch: Scratch, targets: dict[str, dict[str, float]] | None = None, alpha: float = ALPHA,
         keep: float = KEEP_TOKENS, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Cells (source, lang, topic, tokens) with ``share``, their fitted share of a sample of ``keep`` of all tokens,
    and ``most``, the share that keeping them whole gives; and each dimension's targets (see ``feasible``).

    ``targets`` gives a dimension's weights by value. Cells without tokens have share 0. Should the
    marginals contradict each other, the fit ends after ``rounds`` with the last dimension's met; ``reached``
    tells how far the others are off.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    sample = keep * total
    most = F.col("tokens") / F.lit(float(sample)) if sample > 0 else F.lit(0.0)
    share = F.col("tokens") / F.lit(float(total)) if total else F.lit(0.0)
    out = scratch.store(cells.withColumn("most", most.cast("double")).withColumn("share", F.least(share.cast("double"), F.col("most"))))
    aims = {d: feasible(out, d, scratch, (targets or {}).get(d), alpha) for d in DIMENSIONS}
    small, start = {}, out
    for d, aim in aims.items():
        small[d] = aim.count() <= BROADCAST_CELLS
        target = aim.select(d, F.col("target").alias(f"to_{d}"))
        out = out.join(F.broadcast(target) if small[d] else target, d)
    out = scratch.store(out.withColumn("old", F.col("share")))
    scratch.drop(start)
    # a counted table of few cells is one partition: its steps need neither shuffle nor broadcast
    whole = out.count() <= BROADCAST_CELLS
    for _ in range(rounds):
        new = (out.coalesce(1) if whole else out).withColumn("old", F.col("share"))
        for d in DIMENSIONS:
            new = _step(new, d, whole, small[d])
        moved = Observation()
        new = scratch.store(new.observe(moved, F.max(F.abs(F.col("share") - F.col("old"))).alias("most")))
        scratch.drop(out)
        out = new
        if (moved.get["most"] or 0.0) <= tolerance:
            break
    return out.select(*DIMENSIONS, "tokens", "most", "share"), aims


def reached(cells: DataFrame, aims: dict[str, DataFrame]) -> DataFrame:
    """Per dimension and value what was asked, what is feasible (``target``) and the raked ``share``."""
    out = None
    for d in DIMENSIONS:
        got = aims[d].join(cells.groupBy(d).agg(F.sum("share").alias("share")), d).select(
            F.lit(d).alias("dimension"), F.col(d).alias("value"), "asked", "most", "target", "share")
        out = got if out is None else out.union(got)
    return out


def probabilities(cells: DataFrame, scratch: Scratch, keep: float = KEEP_TOKENS, **rake_options) -> DataFrame:
    """Cells with the probability that makes the expected tokens of a cell its share of ``keep`` of all tokens."""
    p = F.when(F.col("most") > 0, F.least(F.lit(1.0), F.col("share") / F.col("most"))).otherwise(F.lit(0.0))
    fitted, _ = rake(cells, scratch, keep=keep, **rake_options)
    return fitted.select(*DIMENSIONS, "tokens", F.round("share", 9).alias("share"), F.round(p, 9).alias("probability"))


def mix(docs: DataFrame, scratch: Scratch, keep: float = KEEP_TOKENS, **rake_options) -> DataFrame:
    """``docs`` (doc_id, text, source, lang, any others) with a struct ``__mix`` of the cell, its
    probability and ``keep``, the document's draw; a column of that name is replaced.

    Texts without words have no weight: they are in no sample unless their cell has words and
    draws them. Repeated rows draw alike; rows without a doc_id draw by their text.
    """
    docs = docs.drop("__mix")
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint")
    cells = docs.select(*cell(docs), words.alias("tokens")).groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))
    fitted = scratch.store(probabilities(scratch.store(cells), scratch, keep, **rake_options))
    fitted = fitted.select(F.struct(*DIMENSIONS).alias("cell"), "probability")
    if fitted.count() <= BROADCAST_CELLS:
        fitted = F.broadcast(fitted)
    # the document's columns stay in one struct, so that no name of theirs meets one of ours
    both = docs.select(F.struct("*").alias("row"), F.struct(*cell(docs)).alias("cell"), draw(F.col("doc_id"), F.col("text")).alias("drawn"))
    return both.join(fitted, "cell").select(
        "row.*", F.struct("cell.*", "probability", (F.col("drawn") < F.col("probability")).alias("keep")).alias("__mix"))
