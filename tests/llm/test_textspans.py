"""Running values, spans apart from others and replaced spans against plain Python, over block borders."""

import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from costlake.llm import textspans

SIZES = [0, 1, 63, 64, 65, 128, 4095, 4096, 4097, 9000]


def test_running(spark):
    rng = random.Random(1)
    rows = [(n, [rng.randint(0, 9) for _ in range(n)]) for n in SIZES]
    frame = spark.createDataFrame(rows, "n int, v array<int>")
    got = frame.select("n", textspans.running_sum(F.col("v")).alias("s"), textspans.running_max(F.col("v")).alias("m")).collect()
    values = dict(rows)
    for r in got:
        assert r["s"] == list(accumulate(values[r["n"]], initial=0))
        assert r["m"] == list(accumulate(values[r["n"]], max, initial=0))


def replaced(text, spans):
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out.append(text[at:start] + f"<{kind.upper()}>")
        at = max(at, end)
    return "".join(out) + text[at:]


def test_replaced_and_apart(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        text = "".join(rng.choice("ab é😀\n") for _ in range(rng.choice([0, 1, 50, 1023, 1024, 1025, 5000])))
        make = lambda n: sorted((a, rng.randint(a + 1, min(len(text), a + rng.choice([1, 5, 2000]))), rng.choice("xy")) for a in (rng.randrange(len(text)) for _ in range(n if text else 0)))  # noqa: E731, B023
        rows.append((i, text, make(rng.choice([0, 1, 5, 200])), make(rng.choice([0, 3, 100]))))
    kind = "array<struct<start:int,end:int,kind:string>>"
    frame = spark.createDataFrame(rows, f"i int, text string, spans {kind}, others {kind}")
    got = frame.select("i", textspans.replace_spans(F.col("text"), F.col("spans")).alias("t"), textspans.apart_from(F.col("spans"), F.col("others")).alias("a")).collect()
    for r in got:
        _, text, spans, others = rows[r["i"]]
        assert r["t"] == replaced(text, spans)
        want = [s for s in spans if not any(s[0] < o[1] and o[0] < s[1] for o in others)]
        assert sorted(tuple(s) for s in r["a"]) == sorted(want)


@pytest.mark.parametrize("pattern, shown", [("[0-9]++", 0), ("[0-9](?=([a-z]{2}))", 1)])
def test_spans_and_their_surroundings(spark, pattern, shown):
    import re

    rng = random.Random(3)
    texts = ["".join(rng.choice("01ab é😀") for _ in range(n)) for n in (0, 1, 40, 500, 3000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = frame.select("i", textspans.find_spans(F.col("text"), pattern, shown, 7, 5).alias("s")).collect()
    for r in got:
        text, matches = texts[r["i"]], list(re.finditer(pattern, texts[r["i"]]))
        assert [(s["start"], s["end"], s["match"]) for s in r["s"]] == [(m.start(), m.end(), m[shown]) for m in matches]
        for s, i in zip(r["s"], range(len(matches))):
            before, after = text[max(0, s["start"] - 7) : s["start"]], text[s["end"] : s["end"] + 5]
            # as far as three further matches reach
            far = matches[i - textspans.REACH - 1].end() if i > textspans.REACH else 0
            near = matches[i + textspans.REACH + 1].start() if i + textspans.REACH + 1 < len(matches) else len(text)
            assert s["before"] == text[max(s["start"] - 7, far, 0) : s["start"]] and before.endswith(s["before"])
            assert s["after"] == text[s["end"] : min(s["end"] + 5, near)] and after.startswith(s["after"])
