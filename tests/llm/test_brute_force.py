"""Operators and pipeline stages row by row against plain Python, and rows that are rare: ties, shared ids, huge numbers, long values."""

import hashlib
import random
import re
import zlib
from bisect import bisect_right

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybeam.llm import bpe, common, entries, exact_dedup, licenses, mixing, quality, sharding, similar, topk, urls, warc
from tests.llm.test_llm import AWKWARD, SCHEMA, awkward, documents, library, naive_groups, naive_rule, naive_targets, nothing

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# --- 1 ---


def random_expression(rng, depth=0):
    """Text, licences and freedom of an expression, built from the leaves up."""
    if depth > 2 or rng.random() < 0.4:
        name = rng.choice(["MIT", "Apache-2.0", "GPL-2.0-only", "GPL-3.0-or-later", "BSD-3-Clause", "CC-BY-NC-4.0", "LicenseRef-own.1", "MPL-2.0", "CC-BY-SA-4.0"])
        value = 0.5 if name.startswith("LicenseRef") else 0.3 if "NC" in name else 0.6 if name.startswith(("GPL", "MPL", "CC-BY-SA")) else 1.0
        if rng.random() < 0.15:
            return f"{name} WITH Some-exception-1.0", {name.lower()}, min(1.0, value + 0.2), 3
        return name, {name.lower()}, value, 4
    operator, rank, f = rng.choice([("OR", 1, max), ("AND", 2, min), ("/", 1, max), ("or", 1, max), ("and", 2, min)])
    (a, x, v, p), (b, y, w, q) = random_expression(rng, depth + 1), random_expression(rng, depth + 1)
    a, b = (f"({a})" if p < rank else a), (f"({b})" if q <= rank else b)
    return f"{a} {operator} {b}" if operator != "/" else f"{a}/{b}", x | y, f(v, w), rank


def naive_phrases(text):
    """Labels, base places and freedoms of all phrases by comparing words at every place."""
    words = WORD.findall(text.translate(LOWER))
    labels, base, values, own = set(), [], [], []
    for i in range(len(words)):
        for table in (licenses.BASE, licenses.NOTICES | licenses.spelt_out()):
            for phrase, label in table.items():
                n = len(phrase.split())
                if words[i : i + n] == phrase.split():
                    if table is licenses.BASE:
                        base.append((i, label))
                        labels.add(label)
                        values.append(licenses.freedom(label))
                    else:
                        own.append((i, i + n, label))
    for i, j, label in own:
        if not any((a, b) != (i, j) and a <= i and j <= b for a, b, _ in own):
            labels.add(label)
            values.append(licenses.freedom(label))
    return len(words), base, labels, values


@pytest.mark.parametrize(
    ("text", "labels", "score"),
    [
        ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International", {"cc-by-nc-sa"}, 0.3), ("Creative Commons Attribution-Non-Commercial-NoDerivs 3.0 Unported", {"cc-by-nc-nd"}, 0.3),
        ("Attribution-NonCommercial 4.0 International", {"cc-by-nc"}, 0.3), ("Creative Commons Attribution-ShareAlike", {"cc-by-sa"}, 0.6), ("Creative Commons Attribution No Derivatives", {"cc-by-nd"}, 0.3),
        ("Creative Commons Attribution 4.0", {"cc-by"}, 1.0), ("Attribution 4.0 International", {"cc-by"}, 1.0), ("attribution is due", set(), 0.5), ("cc by nc sa", {"cc-by", "cc-by-nc-sa"}, 0.3),
        ("License: Sleepycat OR MIT", {"mit"}, 1.0), ("SPDX-License-Identifier: MIT AND Sleepycat AND GPL-3.0-only", {"mit", "gpl-3.0-only"}, 0.5), ("License: GPL v3", {"gpl-3.0"}, 0.6), ("License: Apache 2.0", {"apache-2.0"}, 1.0),
        ("License: LGPL version 2.1 or MIT", {"lgpl-2.1", "mit"}, 1.0), ("license: none of the above", set(), 0.5), ("license: json file", set(), 0.5), ("license: none", {"none"}, 0.0), ("License: JSON OR MIT", {"json", "mit"}, 1.0),
        ("license: that or MIT", set(), 0.5), ("SPDX-License-Identifier: LicenseRef-" + "x" * 300 + " OR MIT", {"licenseref-" + "x" * 300, "mit"}, 1.0), ("License: MIT 2 files", {"mit"}, 1.0), ("License: MIT OR see below", {"mit"}, 1.0),
    ],
)
def test_labels_and_score_of_notices(text, labels, score):
    found = licenses.scan(text.encode())
    assert found.labels == labels and found.score == pytest.approx(score)


def test_licence_scan_of_generated_texts():
    rng = random.Random(11)
    prose = ["some words here", "All Rights Reserved", "cc by", "the license is good", "MIT License", "public domain", "CC-BY-SA", "GNU General Public License, version 3", "É ü 中文", "License agreement", "see the license"]
    for _ in range(1500):
        lines, named, values = [], set(), []
        for _ in range(rng.randint(0, 6)):
            lines.append(rng.choice(prose))
            if rng.random() < 0.5:
                text, found, value, _ = random_expression(rng)
                before, after = rng.choice([("SPDX-License-Identifier: ", ""), ("License: ", ""), ('license = "', '"'), ('{"license": "', '"}'), ("// spdx-license-identifier:", " */"), ("licence => '", "',"), ("SPDX-License-Identifier: ", " and so on"), ("Licensed under the ", ", see below")])
                lines.append(f"{before}{text}{after}")
                named |= found
                values.append(value)
        text = rng.choice(["\n", "\r\n", "\n\n"]).join(lines)
        n_words, base, labels, own = naive_phrases(text)
        got = licenses.scan(text.encode())
        assert (got.n_words, got.n_base) == (n_words, len(base)), text
        assert (got.first_word, got.last_word) == (min((i for i, _ in base), default=None), max((i for i, _ in base), default=None))
        assert got.base_labels == {x for _, x in base} and got.labels == labels | named, text
        assert got.score == pytest.approx(min(own + values, default=0.5)), text


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("SPDX-License-Identifier: this is a sentence", set()), ("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0 AND", {"gpl-2.0"}), ("License: MIT", {"mit"}), ("Apache-2.0 license", {"apache-2.0"}), ("license = \"MIT/Apache-2.0\"", {"mit", "apache-2.0"}),
        ("License: MIT, BSD-2-Clause", {"mit", "bsd-2-clause"}), ("the license MIT", set()), ("License: my own", set()), ('<a rel="license" href="https://creativecommons.org/licenses/by-sa/4.0/">', {"cc-by-sa-4.0"}), ("license: https://example.com/licenses/MIT", set()),
        ("License:\nMIT", set()), ("License: (MIT", {"mit"}), ("License: MIT OR (GPL-2.0-only AND", {"mit", "gpl-2.0-only"}), ("license:" * 50, set()), ("License: " + "x" * 300, set()), ("License: LicenseRef-" + "y" * 60, {"licenseref-" + "y" * 60}),
    ],
)
def test_licences_after_tags(text, labels):
    assert licenses.scan(text.encode()).labels == labels


# --- 2 ---


def test_url_calibration_is_the_logistic_fit_of_held_out_urls(spark):
    rng = random.Random(12)
    word = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    known = [f"http://{word('abcde', 4)}.com/{word('abcdef', 5)}" for _ in range(300)] + [f"http://{word('defgh', 4)}.net/es/{word('cdefgh', 5)}" for _ in range(250)] + [f"http://{word('abcdefgh', 6)}.org/" for _ in range(60)]
    rows = urls.judge(spark.createDataFrame(list(enumerate(known)), "page_id long, url string")).collect()
    held = [(round(r.score / urls.BIN) * urls.BIN, naive_rule(known[r.page_id])[2] == "allow") for r in rows if naive_rule(known[r.page_id])[2] and zlib.crc32(known[r.page_id].encode()) % 5 == 0]
    x, y = np.array([a for a, _ in held]), np.array([b for _, b in held], float)
    loss = lambda a, b: np.logaddexp(0, -(2 * y - 1) * np.clip(a * x + b, -30, 30)).sum() + 5e-4 * ((a - 1) ** 2 + b * b)
    r = max(rows, key=lambda r: abs(r.score))
    slope = (np.log(r.probability / (1 - r.probability)) - np.log(rows[0].probability / (1 - rows[0].probability))) / (r.score - rows[0].score)
    offset = np.log(r.probability / (1 - r.probability)) - slope * r.score
    best = loss(slope, offset)
    assert slope > 0 and all(best <= loss(slope + d, offset + e) + 1e-6 for d in (-0.3, -0.01, 0, 0.01, 0.3) for e in (-0.3, -0.01, 0, 0.01, 0.3))
    for q in rows:
        assert q.probability == pytest.approx(1 / (1 + np.exp(-(slope * q.score + offset))), abs=1e-6)
        if not naive_rule(known[q.page_id])[2]:
            assert q.verdict == ("allow" if q.probability >= 0.5 else "block")


def test_long_urls_are_cut_without_loss():
    rng = random.Random(13)
    known = [bytes(rng.randrange(1, 256) for _ in range(n)) for n in (0, 1, 3, 40, 1000, 0, 7)]
    whole, cut = ([np.concatenate(x).tolist() for x in zip(*urls._packed(known, 5, piece), strict=True)] for piece in (1 << 20, 16))
    assert whole == cut
    want = [(i, u[j], int.from_bytes((bytes(5) + u)[j : j + 5], "big")) for i, u in enumerate(known) for j in range(len(u))]
    assert [*zip(*whole, strict=True)] == want


# --- 3 ---


def test_shards_equal_their_sql(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text").unionByName(awkward(spark, "x").select("doc_id", "text")).union(spark.createDataFrame([(77, "same")] * 3_000, "doc_id long, text string"))
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = con.execute(entries.oracle_sql()["op3_sharding"]).fetchall()
    rows = sharding.assign(docs.repartition(7))
    assert rows.columns == [d[0] for d in con.description]
    assert sorted(map(str, map(tuple, rows.collect()))) == sorted(map(str, want))


# --- 4 ---


def test_copies_that_repeat_an_id_leave_the_same_row(spark):
    rows = [(1, "Same", "a"), (1, "SAME", "b"), (1, "same", "c"), (1, "SAME", "d"), (None, "Null", "e"), (None, "null", "f"), (None, "Null", "g"), (2, "alone", "h"), (3, "twin", "i"), (3, "twin", "i"), (3, None, "j"), (4, "", "k")]
    rows += [(None, "heavy", str(i % 3)) for i in range(500)] + [(9, "Heavy id", "x")] * 300
    frame = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    for k in (2, exact_dedup.K):
        kept = [sorted(map(str, exact_dedup.drop_copies(frame.repartition(n), k).collect())) for n in (1, 2, 5)]
        assert kept[0] == kept[1] == kept[2]
        assert len(kept[0]) == len({(t or "").translate(LOWER) for _, t, _ in rows})


# --- 5 ---


def naive_tree(g, h, n, depth=2):
    """Leaf values by trying every cut."""
    gain = lambda a, b: a * a / (b + quality.RIDGE)
    best, cut = gain(sum(g), sum(h)) + 1e-12, None
    for c in range(1, len(g)) if depth else ():
        if sum(n[:c]) >= quality.LEAST_ROWS and sum(n[c:]) >= quality.LEAST_ROWS and (found := gain(sum(g[:c]), sum(h[:c])) + gain(sum(g[c:]), sum(h[c:]))) > best:
            best, cut = found, c
    if cut is None:
        return [sum(g) / (sum(h) + quality.RIDGE)] * len(g)
    return naive_tree(g[:cut], h[:cut], n[:cut], depth - 1) + naive_tree(g[cut:], h[cut:], n[cut:], depth - 1)


def naive_score(model, x):
    """Probability of label 1 of one row, one table entry after the other."""
    total = model.intercept
    for edges, values, v in zip(model.edges, model.tables, x, strict=True):
        total += values[bisect_right(edges.tolist(), v)]
    for a, b, values in model.pairs:
        total += values[bisect_right(model.coarse[a].tolist(), x[a])][bisect_right(model.coarse[b].tolist(), x[b])]
    return 1 / (1 + np.exp(-total))


def test_trees_equal_an_exhaustive_search():
    rng = np.random.default_rng(14)
    for _ in range(60):
        size = int(rng.integers(1, 14))
        g, h, n = rng.normal(size=size) * 20, rng.uniform(0, 9, size), rng.integers(0, 20, size).astype(float)
        assert quality._tree(g, h, n) == pytest.approx(naive_tree(g.tolist(), h.tolist(), n.tolist()))
        shape = int(rng.integers(2, 6)), int(rng.integers(2, 6))
        g, h, n = rng.normal(size=shape) * 20, rng.uniform(0, 9, shape), rng.integers(8, 20, shape).astype(float)
        best = 0.0
        for axis in (0, 1):
            gs, hs, ns = (np.moveaxis(x, axis, 0) for x in (g, h, n))
            for cut in range(1, len(gs)):
                gain = 0.0
                for rows in (slice(None, cut), slice(cut, None)):
                    sums = [x[rows].sum(axis=0).tolist() for x in (gs, hs, ns)]
                    leaf = naive_tree(*sums, depth=1)
                    for value in set(leaf):
                        at = [i for i, v in enumerate(leaf) if v == value]
                        gain += sum(sums[0][i] for i in at) ** 2 / (sum(sums[1][i] for i in at) + quality.RIDGE)
                best = max(best, gain - g.sum() ** 2 / (h.sum() + quality.RIDGE))
        assert quality._pair_tree(g, h, n)[1] == pytest.approx(best)


def test_scores_equal_a_plain_scorer(spark, sf):
    docs = documents(spark, sf)
    model = quality.train(docs, common.table(spark, sf, "labels"))
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert model.pairs and all(r.score == pytest.approx(naive_score(model, quality.features(texts[r.doc_id]))) for r in quality.score_documents(docs, model).collect())


# --- 6 ---


def test_payloads_beyond_the_read_window(spark, tmp_path):
    rng = random.Random(15)
    noise = "".join(rng.choice("0123456789abcdef") for _ in range(3 << 20))
    pages = spark.createDataFrame([(1, "u", noise), (2, "u", noise), (3, "u", noise[1:]), (4, "u", "é" * (1 << 20))], "page_id long, url string, html string")
    body = {1: noise, 2: noise, 3: noise[1:], 4: "é" * (1 << 20)}
    want = [(i, len(t.encode()), hashlib.sha256(t.encode()).hexdigest(), "revisit" if i == 2 else "response", 1 if i == 2 else None) for i, t in body.items()]
    assert sorted(map(tuple, warc.round_trip(pages).collect())) == want


def test_left_overs_of_failed_attempts_go(tmp_path):
    writer = warc.WarcWriter(f"file://{tmp_path}")
    for name in ("good", "failed"):
        (tmp_path / f".{writer.number}-{name}.warc.gz").write_bytes(b"")
    (tmp_path / ".another.warc.gz").write_bytes(b"")
    writer.commit([warc.Written([f"{writer.number}-good.warc.gz"]), None])
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted([".another.warc.gz", f"{writer.number}-good.warc.gz"])


# --- 7 ---


def test_bpe_of_empty_tables(spark):
    empty = nothing(spark, "ids2")
    assert bpe.encode(empty).count() == bpe.decode(bpe.encode(empty)).count() == bpe.encode_documents(empty).count() == 0


# --- 8 ---


def naive_times(docs):
    """How often each row (doc_id, text, source) is taken: whole epochs, then in order of the hash until the target is reached to half a document."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    place = lambda d, t: int(hashlib.md5(f"{mixing.SEED}:{'null' if d is None else d}:{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest()[: mixing.DIGITS], 16)
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + size(t)
    want, out = naive_targets(sizes), []
    for s in sizes:
        whole = int(want[s] // sizes[s]) if sizes[s] else 0
        rest, upto = want[s] - whole * sizes[s], 0
        for _, d, t in sorted(((place(d, t), d, t) for d, t, x in docs if x == s), key=lambda r: r[0]):
            upto += size(t)
            out.append((d, t, s, size(t), whole + (rest > 0 and upto - size(t) / 2 <= rest)))
    return out, want


@pytest.mark.parametrize("ids", ["null", "single", "pairs", "own"])
def test_mix_with_shared_ids_is_near_its_targets(spark, ids):
    rng = random.Random(16)
    pick = {"null": lambda i: None if i % 2 else i, "single": lambda i: 5, "pairs": lambda i: i // 2, "own": lambda i: i}[ids]
    docs = [(pick(i), "w " * (10 if i % 3 else 7) + (f"x{i}" if ids in ("pairs", "own") else ""), rng.choice(["a", "b", "c", None])) for i in range(3_000)] + [(1, " ", "b"), (None, None, "empty")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("place", F.lit(1)).withColumn("whole", F.lit("x"))
    rows, want = naive_times(docs)
    found = mixing.mix(frame.repartition(6)).collect()
    key = lambda d, n, t: (str(d), n, t)
    assert sorted(key(r.doc_id, r.size, r.taken) for r in found) == sorted(key(d, n, n * k) for d, _, _, n, k in rows)
    for s, target in want.items():
        assert abs(sum(n * k for _, _, x, n, k in rows if x == s) - target) <= max([n for _, _, x, n, _ in rows if x == s], default=0)
    copies = mixing.repeat_documents(frame.repartition(4))
    assert copies.columns == frame.columns
    assert sorted(str((r.doc_id, r.text, r.source)) for r in copies.collect()) == sorted(str((d, t, s)) for d, t, s, n, k in rows for _ in range(k if n else 0))


def test_mix_of_many_sources(spark):
    docs = [(i, "w " * (i % 13 + 1), f"s{i % 700}") for i in range(4_000)]
    rows, want = naive_times(docs)
    found = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    for d, _, s, n, k in rows:
        assert found[d].taken == n * k and found[d].target == pytest.approx(want[s])


# --- 10 ---


def test_top_k_is_exact_for_huge_and_long_vectors(spark):
    rng = random.Random(17)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 0, 3, 7, 12, 18]) for _ in range(rng.choice([2, 5]))]) for i in range(120)]
    rows += [(200, [3.0e6, 0.0]), (300, [1.0, 0.0]), (301, [0.0] * 5_000 + [1.0]), (400, [0.0] * 5_000 + [2.0]), (500, [1e300, -1e300]), (501, [1e300, 1e300]), (0, [0.5, 0.25, 2.0])]
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    want = []
    for q in {i for i, _ in whole if i % 100 == 0}:
        scores = [(max(-topk.MOST, min(topk.MOST, sum(a * b for a, b in zip(v, w, strict=False)))), i) for j, v in whole if j == q for i, w in whole if i != q]
        want += [(q, r, i, s) for r, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:10], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.search_embeddings(frame).collect())) == sorted(want)
    w = topk.weights(frame)
    assert sorted(map(tuple, topk.top_k(w, w.filter("id % 100 = 0"), query_chunk=2).collect())) == sorted(want)


# --- pipeline ---


def naive_similar(docs):
    """Ids that stay: the smallest of each component of word-shingle sets with a similarity of 0.8 or more."""
    sets = []
    for _, t, *_ in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            small, large = sorted((len(sets[i]), len(sets[j])))
            if root[i] != root[j] and 5 * small >= 4 * large and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                root = [root[j] if r == root[i] else r for r in root]
    least = {}
    for r, (d, *_) in zip(root, docs, strict=True):
        least[r] = min(least.get(r, (True, 0)), (d is None, d or 0))
    return sorted(str(None if none else d) for none, d in least.values())


def test_pipeline_stages_equal_brute_force(spark, sf):
    import corpus_pipeline

    names = ["doc_id", "text", "lang", "source", "n_chars"]
    near = [(70_000 + i, " ".join(f"word{j + (j == 5) * i}" for j in range(60)), "en", "near", 1) for i in range(6)]
    docs = documents(spark, sf).select(*names).unionByName(awkward(spark, "x").select(*names)).unionByName(spark.createDataFrame(near, "doc_id long, text string, lang string, source string, n_chars long"))
    labels = common.table(spark, sf, "labels")
    model = quality.train(docs, labels)
    collect = lambda df: [tuple(r[c] for c in names) for r in df.collect()]
    stages = dict(corpus_pipeline.STAGES)

    before, kept = collect(docs), common.materialise(stages["quality_classifier"](spark, docs, sf), "t")
    assert sorted(map(str, collect(kept))) == sorted(str(r) for r in before if naive_score(model, quality.features((r[1] or "").encode())) >= quality.THRESHOLD)

    before, kept = kept.collect(), common.materialise(stages["exact_dedup"](spark, kept, sf), "t")
    want = [max((i for i in ids if i is not None), default=None) for ids in naive_groups(before).values()]
    assert sorted(str(r[0]) for r in collect(kept)) == sorted(map(str, want))

    before, kept = collect(kept), common.materialise(stages["simhash_near_dedup"](spark, kept, sf), "t")
    assert sorted(str(r[0]) for r in collect(kept)) == naive_similar(before) and len(collect(kept)) < len(before)

    before, kept = collect(kept), common.materialise(stages["source_mix"](spark, kept, sf), "t")
    times, _ = naive_times([(d, t, s) for d, t, _, s, _ in before])
    assert sorted(str((d, t, s)) for d, t, _, s, _ in collect(kept)) == sorted(str((d, t, s)) for d, t, s, n, k in times for _ in range(k if n else 0))

    before, t = collect(kept), library()
    tokens = stages["bpe_tokens"](spark, kept, sf).collect()
    assert sorted((str(r.doc_id), r.source, r.ids) for r in tokens) == sorted((str(d), s, t.encode(x, add_special_tokens=False).ids) for d, x, _, s, _ in before)
    assert all(r.round_trip for r in tokens)


def test_pipeline_over_empty_and_awkward_tables(spark, sf, tmp_path):
    import corpus_pipeline

    labels = common.table(spark, sf, "labels")
    for name, docs in (("empty", nothing(spark, "fp")), ("awkward", spark.createDataFrame(AWKWARD, SCHEMA.format(extra="fp")))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert found.columns == ["doc_id", "source", "n_tokens", "ids", "round_trip"] and found.count() == (0 if name == "empty" else found.count())


def test_scratch_needs_a_shared_folder_off_local_masters():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())
    assert similar.WORDS == 5 and similar.LEAST == 80


# --- near-dedup stage ---


@pytest.mark.parametrize("common_from", [1, 3, 10**9])
def test_shared_elements_equal_set_intersections(common_from):
    import pyarrow as pa

    rng = random.Random(18)
    make = lambda n: [sorted(rng.sample(range(-60, 60), rng.randint(0, 50))) for _ in range(n)]
    a, b = make(23), make(17)
    sets = [similar.Sets([pa.array(x[:9], pa.list_(pa.int64())), pa.array(x[9:], pa.list_(pa.int64()))]) for x in (a, b)]
    assert similar.shared(*sets, common_from).tolist() == [[len({*x} & {*y}) for y in b] for x in a]
    same = similar.shared(sets[0], sets[0], common_from)
    assert all(same[i, j] == len({*x} & {*y}) for i, x in enumerate(a) for j, y in enumerate(a) if i != j)


def test_forest_roots():
    rng = np.random.default_rng(19)
    for n in (1, 5, 200):
        pairs = [(rng.integers(0, n, 7), rng.integers(0, n, 7)) for _ in range(n // 20 + 1)]
        want = list(range(n))
        for x, y in ((x, y) for xs, ys in pairs for x, y in zip(xs.tolist(), ys.tolist(), strict=True)):
            want = [min(want[x], want[y]) if r in (want[x], want[y]) else r for r in want]
        assert similar.roots(n, pairs).tolist() == want


def test_a_large_class_of_half_alike_texts(spark):
    """A chain of texts, each like the next only, and a crowd below the limit: many candidates, few links."""
    rng = random.Random(20)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    base = [word() for _ in range(150)]
    docs, words = [], list(base)
    for i in range(60):
        docs.append((i, " ".join(words)))
        words[rng.randrange(150)] = word()
        words[rng.randrange(150)] = word()
    for i in range(60, 140):
        words = list(base)
        for j in range(3, 150, 38):
            words[j] = word()
        docs.append((i, " ".join(words)))
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for options in ({}, {"block_rows": 9, "tile_rows": 11}):
        assert sorted(str(r.doc_id) for r in similar.drop_similar(frame, **options).collect()) == naive_similar(docs)


def test_split_by_a_map_of_bits(spark, monkeypatch):
    docs = spark.range(3_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.lit("x").alias("_tb_word"))
    docs = docs.unionByName(spark.createDataFrame([(None, None, "x"), (7, "", "x")], "doc_id long, text string, _tb_word string"))
    hashes = docs.filter("doc_id < 300 or text is null").select(common.text_hash().alias("h"))
    for most in (common.MOST_BITS, 1 << 13):
        monkeypatch.setattr(common, "MOST_BITS", most)
        stay, maybe = common.split(docs, hashes)
        rows = [{(r.doc_id, r.text) for r in part.collect()} for part in (stay, maybe)]
        assert not rows[0] & rows[1] and len(rows[0]) + len(rows[1]) == 3_002
        assert {(i, f"text {i}") for i in range(300)} | {(None, None)} <= rows[1] and len(rows[1]) < 700
        assert stay.columns == docs.columns
    marks = spark.createDataFrame([(5, "text 5"), (6, "text 9"), (None, None)], "doc_id long, text string").select("doc_id", common.text_hash().alias("h"))
    assert common.drop_marked(docs, marks).count() == 3_000
