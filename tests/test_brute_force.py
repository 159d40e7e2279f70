"""Column rules against plain-Python references, many generated values in
one Spark job each (brute force on a fixture)."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from carelake.functions import columns as C


def test_full_years_matches_calendar_rule(spark):
    rnd = random.Random(7)
    base = dt.date(1996, 1, 1)
    pairs = []
    for _ in range(3000):
        a = base + dt.timedelta(days=rnd.randrange(0, 6000))
        b = a + dt.timedelta(days=rnd.randrange(0, 12000))
        pairs.append((a, b))
    pairs += [(dt.date(2000, 2, 29), dt.date(2023, 2, 28)), (dt.date(2000, 2, 29), dt.date(2023, 3, 1)),
              (dt.date(2004, 2, 29), dt.date(2008, 2, 29)), (dt.date(2001, 12, 31), dt.date(2002, 12, 30))]

    def ref(a, b):
        return b.year - a.year - ((b.month, b.day) < (a.month, a.day))
    df = spark.createDataFrame(pairs, "a date, b date").select("a", "b", C.full_years("a", "b").alias("y"))
    assert all(r.y == ref(r.a, r.b) for r in df.collect())


def test_pct_matches_decimal_half_up(spark):
    rnd = random.Random(11)
    rows = [(rnd.randrange(-5000, 5000), rnd.randrange(-400, 400)) for _ in range(5000)]
    rows += [(57, 20000), (1, 8), (-1, 8), (5, 0), (285, 100000)]

    def ref(n, d, s):
        if d == 0:
            return None
        q = (Decimal(100) * Decimal(n) / Decimal(d)).quantize(Decimal(1).scaleb(-s), rounding=ROUND_HALF_UP)
        return float(q)
    df = spark.createDataFrame(rows, "n long, d long").select(
        "n", "d", C.pct("n", "d", 1).alias("p1"), C.pct("n", "d", 2).alias("p2"))
    for r in df.collect():
        assert r.p1 == ref(r.n, r.d, 1) and r.p2 == ref(r.n, r.d, 2), (r.n, r.d, r.p1, r.p2)


def test_numeric_prefix_matches_reference(spark):
    import re
    rnd = random.Random(3)
    alphabet = "0123456789 ab-"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 8))) for _ in range(3000)] + [None]

    def ref(x):
        if x is None:
            return 0
        m = re.match(r"[0-9]+", x.strip())
        return int(m.group(0)) if m and int(m.group(0)) < 2 ** 31 else 0
    df = spark.createDataFrame([(x,) for x in texts], "t string").select(
        "t", C.numeric_prefix_int("t").alias("v"))
    assert all(r.v == ref(r.t) for r in df.collect())
