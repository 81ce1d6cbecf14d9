"""Fill-in-middle against plain Python, on texts that hold the delimiter, its escape, markers, and characters beyond 16 bits."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tallybeam.llm import entries, fim
from tests.llm.test_llm import awkward, nothing


def naive(key, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, digest = len(units), hashlib.sha256(f"1:{'null' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (n + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, None, text
    if h[3] % 100 < 20:
        return n, "spm", prefix, middle, suffix, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", prefix, middle, suffix, f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_generated_texts(spark):
    rng = random.Random(3)
    bits = ["\x01", "\x02", "\x020", "\x021", "0", "1", "<", "P", ">", "<S", "M>", "a", "Zé", "\U0001f600", "\n", " ", "word", "\r\n", "$1", "\\", "中", "́"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(1500)] + ["<P>", "a<S>b", "<M", "", None, "\x01" * 5, "\x02" * 5, "x" * 100_000, "- " * 50_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in fim.transform(rows).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n, r.form, r.prefix, r.middle, r.suffix, r.output) == naive(i, t)
        assert r.back == (t or "")
    assert {r.form for r in got.values()} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("extra", ["n", "form", "output", "_text", "prefix"])
def test_awkward_rows_and_clashing_names(spark, extra):
    docs = awkward(spark, extra)
    got = sorted(map(tuple, fim.digests(docs).collect()), key=repr)
    want = []
    for d in docs.collect():
        n, form, prefix, middle, _, output = naive(d.doc_id, d.text)
        want.append((d.doc_id, n, form, None if prefix is None else len(prefix), None if middle is None else len(middle), sha(output), sha(d.text or "")))
    assert got == sorted(want, key=repr)
    assert fim.digests(nothing(spark, extra)).count() == 0


def test_other_keys_and_seeds(spark):
    rows = spark.createDataFrame([("k", "one two three four five six")], "name string, body string")
    found = {fim.transform(rows, "name", "body", seed=str(s)).first().output for s in range(6)}
    assert len(found) > 2


def test_no_python_and_no_shuffle(spark, sf):
    plan = entries.op11_fill_in_middle(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
