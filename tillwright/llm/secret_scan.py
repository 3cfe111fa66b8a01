"""Secret scans: known patterns, and a battery of randomness tests for what they miss.

Three kinds of span come from patterns: assignments to words like password or token, access keys
and long hexadecimal runs. Any other long run of letters and digits is a candidate. Its encoding is inferred
(hexadecimal, base 32, 36, 62 or 64) and its characters are tested against that alphabet:

* chi-squared: are all characters of the alphabet equally likely;
* runs: do upper and lower half of the alphabet alternate as often as by chance;
* serial correlation: does a character tell about the next.

A candidate that one of them rejects as random is no secret. The others are held against ordinary
text, whose letters repeat more and change between letters and digits less: that gives a p-value, divided by a
weight that grows with the length, since short runs say little. The Benjamini-Hochberg rule over the
candidates of all documents bounds the share of ordinary words among the spans it adds.

All of it is built-in expressions. A match is placed by the lengths of the texts between matches.
The p-values meet in a histogram of fixed size, so no candidate list is ever gathered or sorted.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import whole, written

#: The patterns and the least sizes of their matches.
ASSIGN = (
    r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "random")

#: A run of letters and digits long enough to be tested.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
#: Expected share of ordinary words among the added spans, and the level of the randomness tests.
FALSE_SHARE = 0.01
RANDOM_LEVEL = 0.001
#: Ordinary text: chance that two letters are the same, that three are, and that the class of
#: character (upper, lower, digit, other) changes from one to the next.
SAME_TWO, SAME_THREE, CLASS_CHANGE = 0.0667, 0.0057, 0.08
#: Length from which a candidate has full weight.
FULL_LENGTH = 40

#: Matches placed together; keeps the work in proportion to the number of matches.
_BLOCK = 128
_BINS = 400  # tenths of a power of ten of the weighted p-value

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ENCODINGS = (
    ("^[0-9a-f]+$", _DIGITS + _LOWER[:6]), ("^[0-9A-F]+$", _DIGITS + _UPPER[:6]),
    ("^[A-Z2-7]+$", _UPPER + "234567"), ("^[a-z0-9]+$", _DIGITS + _LOWER),
    ("^[A-Z0-9]+$", _DIGITS + _UPPER), ("^[A-Za-z0-9]+$", _DIGITS + _UPPER + _LOWER),
)
_BASE64 = _UPPER + _LOWER + _DIGITS + "+/"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(text: Column, pattern: str, kind: int, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs (start, kind, stop, match).

    With `least`, those whose first group is shorter are dropped, after they took part in the
    matching.
    """
    one = "struct<start:int,kind:int,stop:int,match:string>"

    def place(pieces: Column, start: Column) -> Column:
        return F.aggregate(
            pieces, F.struct(start.alias("at"), F.array().cast(f"array<{one}>").alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + F.coalesce(F.length(x["match"]), F.lit(0))).alias("at"),
                F.concat(acc["out"], F.array(F.struct(
                    (acc["at"] + x["gap"]).alias("start"), F.lit(kind).alias("kind"),
                    (acc["at"] + x["gap"] + F.length(x["match"])).alias("stop"),
                    x["match"].alias("match"),
                ))).alias("out"),
            ),
        )

    pieces = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0),
        lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("match")),
    )
    blocks = _let(pieces, lambda p: F.transform(
        F.sequence(F.lit(1), F.size(p), F.lit(_BLOCK)), lambda i: F.slice(p, i, F.lit(_BLOCK))
    ))
    placed = F.aggregate(
        blocks,
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{one}>>").alias("out")),
        lambda acc, block: _let(place(block, acc["at"]), lambda v: F.struct(
            v["at"].alias("at"), F.concat(acc["out"], F.array(v["out"])).alias("out")
        )),
        lambda acc: F.flatten(acc["out"]),
    )
    long_enough = F.filter(placed, lambda s: s["match"].isNotNull() & (
        F.lit(True) if not least
        else F.length(F.regexp_extract(s["match"], pattern, 1)) >= least
    ))
    return F.when(F.rlike(text, F.lit(pattern)), long_enough).otherwise(
        F.array().cast(f"array<{one}>")
    )


def upper_tail(z: Column) -> Column:
    """Normal upper tail: a bound that is within 1.3 % from 0 on, and never below the tail there."""
    def tail(x: Column) -> Column:
        return math.sqrt(2 / math.pi) * F.exp(-x * x / 2) / (x + F.sqrt(x * x + 8 / math.pi))

    return F.when(z >= 0, tail(z)).otherwise(1.0 - tail(-z))


def _alphabet(text: Column) -> Column:
    chosen = F.lit(_BASE64)
    for pattern, alphabet in reversed(_ENCODINGS):
        chosen = F.when(F.rlike(text, F.lit(pattern)), F.lit(alphabet)).otherwise(chosen)
    return chosen


def _class(char: Column) -> Column:
    return (
        F.when(char.between("0", "9"), 0).when(char.between("A", "Z"), 1)
        .when(char.between("a", "z"), 2).otherwise(3)
    )


def _pairs(values: Column, use: Callable[[Column, Column], Column]) -> Column:
    n = F.size(values)
    return F.zip_with(F.slice(values, F.lit(1), n - 1), F.slice(values, F.lit(2), n - 1), use)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def judge(match: Column) -> Column:
    """Struct (random, bin): the battery's word on a run, and its weighted p-value as ordinary text."""
    def tests(of: Column) -> Column:
        values, k, n = of["values"], of["k"], F.size(of["values"]).cast("double")
        pairs = _sum(F.transform(F.array_distinct(values), lambda v: _let(
            F.size(F.filter(values, lambda x: x == v)).cast("double"), lambda c: c * (c - 1)
        )))
        mean = _sum(F.transform(values, lambda v: v.cast("double"))) / n
        spread = _sum(F.transform(values, lambda v: (v - mean) * (v - mean)))
        lagged = _sum(_pairs(values, lambda a, b: (a - mean) * (b - mean)))
        high = _sum(F.transform(values, lambda v: (v * 2 >= k).cast("double")))
        runs = 1.0 + _sum(_pairs(values, lambda a, b: ((a * 2 >= k) != (b * 2 >= k)).cast("double")))
        changes = _sum(_pairs(of["classes"], lambda a, b: (a != b).cast("double")))
        return F.struct(
            n.alias("n"), k.cast("double").alias("k"), pairs.alias("pairs"), spread.alias("spread"),
            lagged.alias("lagged"), high.alias("high"), runs.alias("runs"), changes.alias("changes"),
            (F.size(F.array_distinct(of["classes"])) > 1).alias("mixed"),
        )

    def verdict(t: Column) -> Column:
        n, k = t["n"], t["k"]
        chi = k / n * (t["pairs"] + n) - n  # sum of squares = ordered pairs of equals + n
        z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n))
        middle = 2 * t["high"] * (n - t["high"]) / n + 1
        z_runs = F.when(middle > 2, (t["runs"] - middle) / F.sqrt((middle - 1) * (middle - 2) / (n - 1)))
        z_serial = F.when(t["spread"] > 0, t["lagged"] / t["spread"] * F.sqrt(n))
        least = F.least(
            upper_tail(z_chi), 2 * upper_tail(F.abs(F.coalesce(z_runs, F.lit(9.0)))),
            2 * upper_tail(F.abs(F.coalesce(z_serial, F.lit(9.0)))),
        )
        spread = 4 * (SAME_THREE - SAME_TWO**2) / n + 2 * SAME_TWO * (1 - SAME_TWO) / (n * (n - 1))
        z_same = (SAME_TWO - t["pairs"] / (n * (n - 1))) / F.sqrt(spread)
        z_change = (t["changes"] - CLASS_CHANGE * (n - 1)) / F.sqrt(CLASS_CHANGE * (1 - CLASS_CHANGE) * (n - 1))
        z_text = F.when(t["mixed"], (z_same + z_change) / math.sqrt(2)).otherwise(z_same)
        weighted = upper_tail(z_text) / F.least(F.lit(1.0), n / FULL_LENGTH)
        return F.struct(
            (3 * least >= RANDOM_LEVEL).alias("random"),
            F.least(F.lit(_BINS), F.greatest(F.lit(0), F.floor(-10 * F.log10(F.greatest(weighted, F.lit(1e-300))))
                                             .cast("int"))).alias("bin"),
        )

    text = F.translate(match, "-_", "+/")  # both forms of base 64 are one
    chars = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1)))
    read = _let(_alphabet(text), lambda alphabet: F.struct(
        F.transform(chars, lambda c: F.instr(alphabet, c) - 1).alias("values"),
        F.length(alphabet).alias("k"), F.transform(chars, _class).alias("classes"),
    ))
    return _let(_let(read, tests), verdict)


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"]
    )), ",")


def _cut(found: DataFrame, false_share: float) -> int:
    """The least bin whose candidates the Benjamini-Hochberg rule accepts."""
    bins = found.select(F.explode("_tested").alias("t")).groupBy("t.bin").agg(F.count("*").alias("n"))
    edge = F.pow(F.lit(10.0), -F.col("bin") / 10.0)  # the largest p-value of the bin
    accepted = (
        bins.withColumn("upto", F.sum("n").over(Window.orderBy(F.desc("bin"))))  # at most 401 rows
        .withColumn("all", F.sum("n").over(Window.partitionBy()))
        .where(F.col("upto") * false_share >= F.col("all") * edge)
        .agg(F.min("bin")).first()[0]
    )
    return _BINS + 1 if accepted is None else accepted


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_share: float = FALSE_SHARE
) -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, base_sha256, spans, found.

    `spans` names all spans as kind:start:end (code points, end exclusive), joined by commas;
    `base_sha256` is the hash of that string over the patterns' spans alone; `found` holds the
    spans as structs with their texts. Patterns' spans always stay; a candidate that touches one is not
    tested. Null counts as empty: no spans. Rows that repeat each count. Other columns are not
    read. Rows never move; the text is read once.
    """
    base = F.concat(
        _spans(F.col("_text"), ASSIGN, 0, ASSIGN_LEAST), _spans(F.col("_text"), ACCESS, 1),
        _spans(F.col("_text"), HEX, 2),
    )
    rows = docs.select(F.col(id_col).alias("_id"), whole(text_col).alias("_text"))
    rows = rows.select("_id", base.alias("_base"), _spans(F.col("_text"), CANDIDATE, 3).alias("_seen"))
    fresh = F.filter("_seen", lambda c: ~F.exists(
        "_base", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])
    ))
    tested = F.transform(fresh, lambda c: _let(judge(c["match"]), lambda j: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["stop"].alias("stop"),
        c["match"].alias("match"), j["random"].alias("random"), j["bin"].alias("bin"),
    )))
    found = written(rows.select("_id", "_base", tested.alias("_tested")), "secret-spans")
    cut = _cut(found, false_share)
    added = F.transform(
        F.filter("_tested", lambda t: t["random"] & (t["bin"] >= cut)),
        lambda t: F.struct(t["start"], t["kind"], t["stop"], t["match"]),
    )

    def count(kind: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")

    everything = F.array_sort(F.concat("_base", added))
    return found.select(
        F.col("_id").alias(id_col), count(0).alias("n_assign"), count(1).alias("n_access"),
        count(2).alias("n_hex"), F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
        _joined(everything).alias("spans"), everything.alias("found"),
    )
