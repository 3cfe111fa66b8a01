"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. The token weights of the cells are
raked: scaled so that they sum to the target of each source, then of each language, then of each
topic, and again until all targets hold or the error stops falling. The raked weight of a cell over its tokens calibrates the
probability with which each of its documents is drawn; probabilities that would pass one stay at
one, and the others rise until the expected tokens meet the budget.

Only built-in expressions. Documents are summed to cells before anything is shuffled, and the
cells stay a table, however many sources there are.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tillwright.llm.common import whole, written
from tillwright.operators.joins import attach

DIMENSIONS = ("source", "lang", "topic")
#: A dimension's targets: shares by value, or an exponent of the observed shares.
TARGETS: dict[str, Mapping[str, float] | float] = {"source": 0.5, "lang": 0.7, "topic": 0.8}
#: Share of all tokens that the sample is to hold, as far as probabilities of one allow.
KEEP = 0.75
#: The relative error that ends the rounds over all dimensions, and the rounds that must lower it by a
#: tenth for more to follow.
CLOSE = 1e-10
ROUNDS = 25
#: Rounds in one job.
STEP = 4
SEED = 42


def topic_of(text: Column) -> Column:
    """A coarse topic of a text by its marks; null counts as empty."""
    text = whole(text)
    return (
        F.when(F.contains(text, F.lit("icense")) | F.contains(text, F.lit("opyright")), "legal")
        .when(F.contains(text, F.lit("@")), "contact")
        .when(F.contains(text, F.lit("=")), "technical")
        .otherwise("prose")
    )


def draw(identity: Column, text: Column, seed: int = SEED) -> Column:
    """A number from 0 up to 1 that depends on the id (without one, on the text) and the seed."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.md5(whole(text))))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(1 << 52)


def _labelled(docs: DataFrame, id_col: str, text_col: str, topic: Column | None) -> DataFrame:
    """Rows with their cell; a null source or language counts as the empty name."""
    text = F.col(text_col)
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}") for c in ("source", "lang")]
    labelled = docs.select("*", *names, (topic_of(text) if topic is None else topic).alias("_topic"))
    return labelled.withColumns({
        "_cell": F.concat_ws("\x01", *(f"_{d}" for d in DIMENSIONS)),
        "_draw": draw(F.col(id_col), text),
        "_tokens": F.regexp_count(whole(text), F.lit(r"\S+")).cast("long"),
    })


def cell_tokens(rows: DataFrame) -> DataFrame:
    """One row per cell: names, tokens, and the weight to start from."""
    cells = rows.groupBy(*(f"_{d}" for d in DIMENSIONS)).agg(F.sum("_tokens").alias("_tokens"))
    return written(
        cells.where("_tokens > 0")
        .withColumn("_cell", F.concat_ws("\x01", *(f"_{d}" for d in DIMENSIONS)))
        .withColumn("_weight", F.col("_tokens").cast("double")),
        "mix-cells",
    )


def target_shares(cells: DataFrame, dimension: str, target: Mapping[str, float] | float) -> DataFrame:
    """`_<dimension>, _share`, summing to one over the values that have tokens.

    An exponent e gives each value its observed share to the power of e. With shares by name, what
    they leave of one goes to the other values by their tokens; values with a share but no tokens are passed over.
    """
    name = f"_{dimension}"
    seen = cells.groupBy(name).agg(F.sum("_tokens").cast("double").alias("_seen"))
    if isinstance(target, Mapping):
        shares = F.from_json(F.lit(json.dumps(dict(target))), "map<string,double>")
        named = F.try_element_at(shares, F.col(name))
        rest = max(0.0, 1.0 - sum(target.values()))
        others = seen.where(named.isNull()).agg(F.sum("_seen")).first()[0] or 1.0
        raw = F.coalesce(named, F.col("_seen") * F.lit(rest / others))
    else:
        raw = F.pow("_seen", F.lit(float(target)))
    seen = seen.select(name, raw.alias("_raw"))
    total = seen.agg(F.sum("_raw")).first()[0] or 1.0
    return written(seen.select(name, (F.col("_raw") / F.lit(total)).alias("_share")), "mix-targets")


def residuals(cells: DataFrame, shares: Mapping[str, DataFrame]) -> dict[str, float]:
    """Per dimension the largest error of a value's weight, relative to its target (a target of 0: to all)."""
    total = float(cells.agg(F.sum("_tokens")).first()[0] or 0)
    out = {}
    for dimension, share in shares.items():
        now = cells.groupBy(f"_{dimension}").agg(F.sum("_weight").alias("_now")).join(share, f"_{dimension}")
        aim = F.col("_share") * F.lit(total)
        off = F.abs(F.col("_now") - aim) / F.when(aim > 0, aim).otherwise(F.lit(total))
        out[dimension] = now.agg(F.max(off)).first()[0] or 0.0
    return out


def rake(
    cells: DataFrame, targets: Mapping[str, Mapping[str, float] | float] = TARGETS,
    rounds: int = ROUNDS, close: float = CLOSE,
) -> DataFrame:
    """`cells` with `_weight` raked to the targets; weights sum to the tokens of all cells.

    Rounds go on until the relative error is at most `close`, or about `rounds` of them have not lowered it by a
    tenth. So it is with targets that contradict each other over empty cells, which cannot all hold;
    then the weights are those after the last round, and a warning names the error of each dimension.

    Every cell carries its targets, so a round is a sum over each dimension and nothing is joined. `STEP`
    rounds are one job, and the error is observed as it writes.
    """
    total = float(cells.agg(F.sum("_tokens")).first()[0] or 0)
    shares = {d: target_shares(cells, d, t) for d, t in targets.items()}
    for dimension, share in shares.items():
        aim = share.select(f"_{dimension}", (F.col("_share") * F.lit(total)).alias(f"_aim_{dimension}"))
        cells = cells.join(aim, f"_{dimension}")
    aims = [f"_aim_{d}" for d in shares]
    cells = written(cells, "mix-aims")
    patience = max(1, rounds // STEP)
    errors: list[float] = []
    while True:
        for number in range(STEP):
            for dimension in shares:
                now = F.sum("_weight").over(Window.partitionBy(f"_{dimension}"))
                cells = cells.withColumn("_now", now)
                aim, last = F.col(f"_aim_{dimension}"), number == STEP - 1
                factor = F.when(F.col("_now") > 0, aim / F.col("_now")).otherwise(0.0)
                holds = (F.col("_now") <= 0) & (aim <= 0)
                cells = cells.withColumns({
                    "_weight": F.col("_weight") * factor,
                    **({f"_off_{dimension}": F.when(holds, 0.0).otherwise(F.abs(factor - 1))} if last else {}),
                }).drop("_now")
        offs = [F.col(f"_off_{d}") for d in shares]
        seen = Observation()
        cells = cells.observe(seen, F.max(F.greatest(F.lit(0.0), *offs)).alias("off"))
        cells = written(cells.drop(*(f"_off_{d}" for d in shares)), "mix-rounds")
        off = seen.get["off"]
        if off is None or off <= close:
            return cells.drop(*aims)
        errors.append(off)
        if len(errors) > patience and min(errors[-patience:]) > 0.9 * min(errors[:-patience]):
            break
    left = ", ".join(f"{d} {e:.2g}" for d, e in residuals(cells, shares).items())
    warnings.warn(f"targets of the mixture do not all hold; relative errors left: {left}", stacklevel=2)
    return cells.drop(*aims)


def calibrate(cells: DataFrame, keep: float = KEEP) -> DataFrame:
    """`_cell, _chance`: min(1, c * weight / tokens) with c such that the tokens meet the budget."""
    tokens, weight = F.col("_tokens").cast("double"), F.col("_weight")
    total, mass = cells.agg(F.sum(tokens), F.sum(weight)).first()
    if not total:
        return cells.select("_cell", F.lit(0.0).alias("_chance"))
    budget, c, full = keep * total, keep * total / mass, 0
    while True:
        capped = weight * c >= tokens
        count, taken, used = cells.where(capped).agg(F.count("*"), F.sum(tokens), F.sum(weight)).first()
        if count == full or used >= mass:
            break
        full, c = count, (budget - taken) / (mass - used)
    return cells.select("_cell", F.least(F.lit(1.0), weight * c / tokens).alias("_chance"))


def _drawn(rows: DataFrame, cells: DataFrame, targets, keep: float) -> DataFrame:
    chances = written(calibrate(rake(cells, targets), keep), "mix-chances")
    found = attach(rows, chances, "_cell", "left")
    chance = F.coalesce("_chance", F.lit(0.0))
    return found.withColumn("_chance", chance).withColumn("_sampled", F.col("_draw") < chance)


def mix(
    docs: DataFrame, targets: Mapping[str, Mapping[str, float] | float] = TARGETS, keep: float = KEEP,
    id_col: str = "doc_id", text_col: str = "text", topic: Column | None = None,
) -> DataFrame:
    """Per row: id, source, lang, topic, tokens, chance, sampled.

    A null source or language counts as the empty name, a null text as empty. Texts without a
    token have a chance of 0 where their cell has no tokens. Rows that share an id share the draw; rows
    without one draw by their text. Other columns are not read. An empty table stays empty.
    """
    rows = written(
        _labelled(docs.select(id_col, text_col, "source", "lang"), id_col, text_col, topic)
        .select(F.col(id_col).alias("_id"), *(f"_{d}" for d in DIMENSIONS), "_cell", "_draw", "_tokens"),
        "mix-rows",
    )
    drawn = _drawn(rows, cell_tokens(rows), targets, keep)
    return drawn.select(
        F.col("_id").alias(id_col), *(F.col(f"_{d}").alias(d) for d in DIMENSIONS),
        F.col("_tokens").alias("tokens"), F.col("_chance").alias("chance"), F.col("_sampled").alias("sampled"),
    )


def sample_mix(
    docs: DataFrame, targets: Mapping[str, Mapping[str, float] | float] = TARGETS, keep: float = KEEP,
    id_col: str = "doc_id", text_col: str = "text", topic: Column | None = None,
) -> DataFrame:
    """The rows of `docs` that :func:`mix` draws, with their columns, whatever the names of those.

    Nulls, empty texts, repeated rows, rows without an id and empty tables are as in :func:`mix`; texts of any
    length are counted whole.
    """
    boxed = docs.select(F.struct("*").alias("_row"), id_col, text_col, "source", "lang")
    rows = _labelled(boxed, id_col, text_col, topic)
    drawn = _drawn(rows, cell_tokens(rows), targets, keep)
    return drawn.where("_sampled").select("_row.*")
