import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tillwright.llm import fill_middle as fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, seed=42, share=50, suffix_first=80):
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= share:
        return len(units), "plain", None, None, text
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    if h[3] % 100 < suffix_first:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def result(df, recipe=fim.Recipe()):
    made = fim.fill_in_middle(df, recipe)
    again = made.withColumn("again", fim.restored(F.col("output"), F.col("form"), recipe))
    return [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["again"]) for r in again.collect()]


def key(row):
    return tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in row)


def expected(rows, **settings):
    return sorted(((i, *brute(i, t or "", **settings), t or "") for i, t in rows), key=key)


@pytest.mark.parametrize("share, suffix_first", [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_equals_brute_force(spark, texts, odd, documents, share, suffix_first):
    rows = [*odd, *documents[:60], (20, "a <P b"), (21, "<P>"), (22, "x<S"), (23, "<<S"), (24, " <M> "), (25, "\v\f\r a\x1c b\x85c"),
            (26, "   "), (27, "<"), (28, "<P <S <M"), (29, "end<P"), (30, "a" * 70000), (31, "A\x00b c")]
    recipe = fim.Recipe(share=share, suffix_first=suffix_first)
    assert sorted(result(texts(*rows), recipe), key=key) == expected(rows, share=share, suffix_first=suffix_first)


def test_forms_come_in_their_shares(texts, documents):
    rows = [(i, "a b c d") for i in range(3000)]
    forms = [r[2] for r in result(texts(*rows))]
    assert abs(forms.count("plain") / 3000 - 0.5) < 0.05
    assert abs(forms.count("spm") / (3000 - forms.count("plain")) - 0.8) < 0.05


def test_sections_end_with_units():
    text = "alpha  beta\n\n \t gamma " * 300 + "x" * 5000 + "   "
    ends = [m.end() for m in UNIT.finditer(text)]
    for section in (1, 7, 100, 5000, 1 << 20):
        assert list(fim.unit_ends(text, section)) == ends
    long = "ab c\n " * 1_200_000
    found = fim.unit_ends(long)
    assert len(found) == 2_400_001 and found[-1] == len(long)


def test_empty_table(texts):
    assert result(texts((1, "a")).limit(0)) == []
