"""Sharding, quality rules and the classifier."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.llm import classifier, quality, sharding


def test_shards_are_even_and_whole(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sharding.assign_shards(docs).collect()
    counts = [sum(r.shard == s for r in rows) for s in range(24)]
    assert sum(counts) == docs.count() and max(counts) - min(counts) <= 1
    for s in range(24):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    sizes = {r.doc_id: len(r.text.encode()) + 8 for r in docs.collect()}
    assert all(r["size"] == sizes[r.doc_id] for r in rows)


def test_movement_is_limited(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    of = lambda n: {r.doc_id: r.shard for r in sharding.assign_shards(docs, n).collect()}
    a, b = of(24), of(25)
    assert sum(a[d] != b[d] for d in a) < 0.08 * len(a)


def test_placement_equals_walking_the_ring(spark):
    """Row by row: homes first, each arc's rows in hash order, then overflow clockwise; slots in the order of filling."""
    import xxhash

    rows = [(i * 37 % 5000, "t" * (i % 5)) for i in range(1500)] + [(7, "t"), (7, "u")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    n, virtual = 5, 16
    ring = sorted((xxhash.xxh64_intdigest(f"{s}:{v}"), s) for s in range(n) for v in range(virtual))
    points = [p for p, _ in ring]
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h"), F.crc32(F.encode("text", "UTF-8")).alias("crc")).collect()
    arcs = {}
    for r in keyed:
        arcs.setdefault(int(np.searchsorted(points, r.h % 2**64)) % len(points), []).append((r.h, r.doc_id, r.crc, len(r.text) + 8))
    room, filled, want, over = sharding.bounds(len(rows), n), [0] * n, [], []
    for a in sorted(arcs):
        for key in sorted(arcs[a]):
            s = ring[a][1]
            if filled[s] < room[s]:
                want.append((*key[1:], s, filled[s]))
                filled[s] += 1
            else:
                over.append((a, key))
    for a, key in over:
        s = next(ring[(a + i) % len(ring)][1] for i in range(len(ring)) if filled[ring[(a + i) % len(ring)][1]] < room[ring[(a + i) % len(ring)][1]])
        want.append((*key[1:], s, filled[s]))
        filled[s] += 1
    got = [(r.doc_id, r.text_crc32, r["size"], r.shard, r.slot) for r in sharding.assign_shards(docs, n, virtual).collect()]
    assert sorted(got) == sorted(want)


def test_stretches_equal_placing_one_by_one():
    rng = np.random.default_rng(4)
    owner = rng.integers(0, 5, 40)
    arcs = {int(a): int(n) for a, n in enumerate(rng.integers(0, 9, 40)) if n}
    most = sharding.bounds(sum(arcs.values()), 5)
    left, want, over = list(most), {}, []
    for a in sorted(arcs):
        for rank in range(arcs[a]):
            if left[owner[a]]:
                left[owner[a]] -= 1
                want[a, rank] = owner[a]
            else:
                over.append((a, rank))
    for a, rank in over:
        s = next(owner[(a + i) % 40] for i in range(40) if left[owner[(a + i) % 40]])
        left[s] -= 1
        want[a, rank] = s
    got = {(a, r): s for a, start, stop, s, _ in sharding.stretches(arcs, owner, most) for r in range(start, stop)}
    assert got == want


def test_sharding_edges(edge, empty, edge_rows):
    rows = sharding.assign_shards(edge).collect()
    assert len(rows) == len(edge_rows) and sorted(r["size"] for r in rows if r.doc_id == 2) == [8]
    assert sharding.assign_shards(empty).count() == 0


# --- quality -----------------------------------------------------------------------------------


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, repeats = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + j for at in places.values() if len(at) > 1 for i in at for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered)


def test_counts_equal_brute_force(spark, sf_dir):
    rng = np.random.default_rng(6)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += ["".join(rng.choice(list("ab \n\t\x0b|#é\xa0\x85"), 200)) for _ in range(300)]
    texts += [" ".join(rng.choice(["a", "b"], 60)) for _ in range(100)] + ["", " \n \n", "x\nx\nx", "\n\n"]
    for text in texts:
        assert quality.base_counts(text) == brute_counts(text)


def brute_model(texts, order=4):
    """Interpolated modified Kneser-Ney in plain dictionaries: log p of each gram of a text."""
    from collections import Counter

    pad = chr(quality.START) * (order - 1)
    counts = {order: Counter((pad + t)[i : i + order] for t in texts for i in range(len(t)))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    vocabulary = len(counts[1])

    def discounts(k):
        n = [sum(v == i for v in counts[k].values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
        out = []
        for i in (1, 2, 3):
            d = i - (i + 1) * y * n[i + 1] / n[i] if n[1] and n[i] else -1
            out.append(d if 0 < d < i else i / 2)
        return out

    ds = {k: discounts(k) for k in counts}
    context = {k: {} for k in counts}
    for k in counts:
        for g, n in counts[k].items():
            total, mass = context[k].get(g[:-1], (0, 0))
            context[k][g[:-1]] = total + n, mass + ds[k][min(n, 3) - 1]

    def p(g):
        if not g:
            return 1 / vocabulary
        k, n = len(g), counts[len(g)][g]
        total, mass = context[k][g[:-1]]
        return (n - ds[k][min(n, 3) - 1]) / total + mass / total * p(g[1:])

    return lambda t: -sum(np.log(p((pad + t)[i : i + order])) for i in range(len(t))) / len(t)


def test_perplexity_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    rows = docs.collect()
    got = {r.doc_id: r.log_perplexity for r in quality.quality_scores(docs).collect()}
    for lang in {r.lang for r in rows}:
        model = brute_model(list(dict.fromkeys(r.text for r in rows if r.lang == lang)))  # equal texts count once
        for r in [r for r in rows if r.lang == lang][:5]:
            assert got[r.doc_id] == pytest.approx(model(r.text), abs=2e-4)


def brute_held_out(texts, one, order=4):
    """Mean surprise of texts[one] by the counts of the other texts, with the discounts and the characters of all."""
    from collections import Counter

    def counted(texts):
        pad = chr(quality.START) * (order - 1)
        counts = {order: Counter((pad + t)[i : i + order] for t in texts for i in range(len(t)))}
        for k in range(order - 1, 0, -1):
            counts[k] = Counter(g[1:] for g in counts[k + 1])
        return counts

    whole, counts = counted(texts), counted(texts[:one] + texts[one + 1 :])
    discounts = {}
    for k in whole:
        n = [sum(v == i for v in whole[k].values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
        ds = [i - (i + 1) * y * n[i + 1] / n[i] if n[1] and n[i] else -1 for i in (1, 2, 3)]
        discounts[k] = [0] + [d if 0 < d < i else i / 2 for i, d in enumerate(ds, 1)]

    def p(g):
        if not g:
            return 0
        k, after = len(g), {x: n for x, n in counts[len(g)].items() if x[:-1] == g[:-1]}
        below = p(g[1:]) if k > 1 else 1 / len(whole[1]) if g in counts[1] else 1 / (1 << quality.BITS)
        if not after:
            return below
        n, d, total = after.get(g, 0), discounts[k], sum(after.values())
        return (n - d[min(n, 3)]) / total + sum(d[min(x, 3)] for x in after.values()) / total * below

    text = texts[one]
    padded = chr(quality.START) * (order - 1) + text
    return sum(min(quality.MOST_SURPRISE, -np.log(p(padded[i : i + order]))) for i in range(len(text))) / len(text)


def test_held_out_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcd ") + ([str(i)] if i < 4 else []), int(rng.integers(3, 60)))) for i in range(12)] + ["abab abab", "abab abab", "zzz"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.log_held_out for r in quality.quality_scores(docs).collect()}
    once = list(dict.fromkeys(texts))  # equal texts are one, and leave together
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(brute_held_out(once, once.index(text)), abs=1e-6)


@pytest.fixture(scope="module")
def judged(spark):
    """sf0.01 with its scores and labels."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    return quality.quality_scores(docs).join(labels, "doc_id", "left").toPandas()


def test_band_rejects_labelled_junk(judged):
    junk = judged[(judged.quality == 0) & ~judged.base_failed]
    assert (~junk.kept.astype(bool)).mean() >= 0.5 and len(junk) > 20


def brute_kept(scores):
    """kept from the definition: sorted values, a range of quartiles, a width for each text."""
    ranges, use = {}, [r for r in scores if r.n_words >= 20 and r.log_held_out is not None and r.log_held_out == r.log_held_out]
    for lang in {r.lang for r in use}:
        values = sorted(round(r.log_held_out, 3) for r in use if r.lang == lang)
        ranges[lang] = (values[-(-len(values) // 4) - 1], values[-(-3 * len(values) // 4) - 1], len(values))
    mean = sum((high - low) * n for low, high, n in ranges.values()) / sum(n for *_, n in ranges.values())
    out = []
    for r in scores:
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        low, high, _ = ranges.get(r.lang, (0, 0, 0))
        width = quality.SPREAD * max(high - low, quality.LEAST_SHARE * mean) * (1 + quality.EVEN_CHARS / max(1, r.word_chars)) ** 0.5
        out.append(not failed and (r.lang not in ranges or low - width <= r.log_held_out <= high + width))
    return out


def test_verdicts_equal_brute_force(judged):
    rows = list(judged.itertuples())
    assert brute_kept(rows) == judged.kept.tolist()


def test_verdicts_do_not_hang_on_the_number_of_rows(spark, judged):
    """The same rows nine times over, under other ids: the same verdicts."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", "text")
    verdicts = lambda df: {(r.doc_id % 100000, r.kept, r.log_held_out) for r in quality.quality_scores(df).collect()}
    nine = docs.crossJoin(spark.range(9)).withColumn("doc_id", F.col("doc_id") + F.col("id") * 100000).drop("id")
    once, often = verdicts(docs), verdicts(nine)
    assert {x[:2] for x in once} == {x[:2] for x in often}
    assert dict((x[0], x[2]) for x in once) == pytest.approx(dict((x[0], x[2]) for x in often), nan_ok=True)


def test_noise_goes_in_every_language(spark):
    """A hundred documents of each language, of which five are letters at random: these go, and of the others at most three."""
    import random

    rng, rows = random.Random(3), []
    for k, lang in enumerate(("aa", "bb", "cc", None)):
        letters = "abcdefghijklmnopqrstuvwxyz"[k * 5 : k * 5 + 11]
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(150)]
        for i in range(100):
            noise = i % 20 == 7
            word = (lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz#%") for _ in range(5))) if noise else (lambda words=words: rng.choice(words))
            rows.append((k * 1000 + i, lang, " ".join(word() for _ in range(rng.randint(60, 200)))))
    got = {r.doc_id: r.kept for r in quality.quality_scores(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()}
    for k in range(4):
        assert not any(got[k * 1000 + i] for i in range(100) if i % 20 == 7)
        assert sum(not got[k * 1000 + i] for i in range(100) if i % 20 != 7) <= 3


def test_unseen_grams_back_off(spark):
    docs = spark.createDataFrame([(1, "abcabcabc abd", "en")], "doc_id long, text string, lang string")
    model = quality.model_arrays(quality.count_grams(docs))["en"]
    seen, unseen = (model.log_p(quality.grams([t])[0]) for t in ("abcabc", "zzzzzz"))
    assert np.isfinite(unseen).all() and unseen.mean() < seen.mean() - 1
    pruned = quality.model_arrays(quality.count_grams(docs), max_grams=3)["en"]
    assert np.isfinite(pruned.log_p(quality.grams(["abcabc"])[0])).all()


def test_no_gram_leaves_a_large_model(spark):
    rng = np.random.default_rng(8)
    docs = spark.createDataFrame([(i, "".join(rng.choice(list("abcdefgh "), 200)), "de" if i == 0 else "en") for i in range(9)], "doc_id long, text string, lang string")
    counts = quality.count_grams(docs).cache()
    whole, pieces = quality.model_arrays(counts), quality.model_arrays(counts, max_grams=100)
    for r in docs.collect():
        code = quality.grams([r.text])[0]
        assert pieces[r.lang].log_p(code) == pytest.approx(whole[r.lang].log_p(code), abs=1e-9)
    scores = [{r.row.doc_id: r.log_perplexity for r in quality.scored(docs, m).collect()} for m in (whole, pieces)]
    assert scores[0] == pytest.approx(scores[1], abs=1e-9)


def test_hash_array_finds_all():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 63, 5000, np.uint64))
    table = quality.HashArray(keys[::2], np.arange(len(keys[::2]), dtype=np.float32))
    found = table.find(keys)
    assert (found[::2] == np.arange(len(keys[::2]))).all() and np.isnan(found[1::2]).all()


def test_bands_of_small_languages(spark):
    """Every language has a band, and quartiles don't hang on how rows are dealt out."""
    rng = np.random.default_rng(4)
    rows = [("big", 30, float(x)) for x in rng.normal(2, 0.1, 4000)] + [("small", 30, x) for x in (2.0, 2.0, 2.0, 2.1)] + [(None, 30, 3.0), ("short", 3, 9.0)]
    scores = spark.createDataFrame(rows, "lang string, n_words long, log_held_out double")
    got = {r.band_lang: r for r in quality.bands(scores).collect()}
    assert set(got) == {"big", "small", None}
    assert got["small"].low - got["small"].width < 2.1 < got["small"].high + got["small"].width and got[None].width > 0
    want = np.quantile(np.round([x for lang, _, x in rows if lang == "big"], 3), [0.25, 0.75], method="inverted_cdf")
    assert (got["big"].low, got["big"].high) == pytest.approx(tuple(want))
    assert got == {r.band_lang: r for r in quality.bands(scores.repartition(13)).collect()}


def test_clean_documents_stay(judged):
    """Of the eight that go six are texts in two languages."""
    good = judged[(judged.quality == 1) & ~judged.base_failed]
    assert good.kept.mean() >= 0.97


def test_quality_edges(edge, empty, edge_rows):
    rows = quality.quality_scores(edge).collect()
    assert len(rows) == len(edge_rows) and all(r.base_failed and not r.kept for r in rows if r.n_words < 20)
    assert quality.quality_scores(empty).count() == 0
    kept = quality.good_documents(edge)
    assert kept.columns == edge.columns and kept.count() == 0


# --- classifier --------------------------------------------------------------------------------


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.pmod(F.col("doc_id"), F.lit(4)) == 0
    rows = classifier.classify(docs, labels.where(~held)).join(labels.where(held), "doc_id").select("quality", "kept").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_sparse_sites_shrink(spark):
    rng = np.random.default_rng(8)
    clean, junk = "The quiet river moves along the old stone wall. " * 6, "### $$$ buy | now !!! %%% 1234 " * 9
    rows, labels = [], []
    for i in range(600):
        bad = rng.random() < (0.9 if i % 2 else 0.1)
        rows.append((i, junk if bad else clean, "bad.example" if i % 2 else "good.example", f"/p{i % 7}"))
        labels.append((i, 0 if bad else 1))
    rows += [(1000, clean, "new.example", "/a"), (1001, clean, "bad.example", "/p1")]
    got = classifier.classify(spark.createDataFrame(rows, "doc_id long, text string, host string, path string"), spark.createDataFrame(labels, "doc_id long, quality int"), "host", "path")
    of = {r.doc_id: r for r in got.collect()}
    assert of[1001].path_p < of[1000].path_p < max(r.path_p for r in of.values())
    assert abs(of[1000].host_p - 0.5) < 0.25 and of[1].host_p < 0.3 < 0.7 < of[0].host_p


def brute_posteriors(rows, prior, threshold=classifier.THRESHOLD):
    """rows: (id, host, path, log odds). The estimates in plain Python."""
    p = {d: 1 / (1 + np.exp(-s)) for d, _, _, s in rows}
    mean = sum(p.values()) / len(p)

    def sums(key):
        out = {}
        for r in rows:
            k, n = out.get(key(r), (0.0, 0))
            out[key(r)] = k + p[r[0]], n + 1
        return out

    def strength(groups):
        ks, ns = np.array([g[0] for g in groups.values()]), np.array([g[1] for g in groups.values()], float)
        if len(ns) < 2:
            return 100.0
        spread = (ns * (ks / ns - mean) ** 2).sum() - (len(ns) - 1) * mean * (1 - mean)
        between = spread / (ns.sum() - (ns**2).sum() / ns.sum())
        return float(np.clip(mean * (1 - mean) / between - 1, 1, 1e4)) if between > 0 else 1e4

    hosts, paths = sums(lambda r: r[1]), sums(lambda r: r[1:3])
    by_host, by_path = strength(hosts), strength(paths)
    out = {}
    for d, host, path, score in rows:
        host_p = (hosts[host][0] + by_host * mean) / (hosts[host][1] + by_host)
        path_p = (paths[host, path][0] - p[d] + by_path * host_p) / (paths[host, path][1] - 1 + by_path)
        odds = np.log(path_p / (1 - path_p)) + score - np.log(prior / (1 - prior))
        quality = 1 / (1 + np.exp(-odds))
        out[d] = (p[d], host_p, path_p, quality, bool(quality >= threshold))
    return out


def test_posteriors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, f"h{int(rng.zipf(1.6)) % 40}", f"/{rng.integers(0, 4)}", float(rng.normal(1, 2))) for i in range(900)]
    model = classifier.Classifier((1.0,) + (0.0,) * (classifier.N_FEATURES - 1), 0.0, 0.7)
    table = spark.createDataFrame([(d, h, p, [s] + [0.0] * (classifier.N_FEATURES - 1)) for d, h, p, s in rows], "doc_id long, host string, path string, x array<double>")
    want = brute_posteriors(rows, 0.7)
    for r in classifier.posteriors(table, model).collect():
        assert tuple(r)[1:5] == pytest.approx(want[r.doc_id][:4], abs=1e-9) and r.kept == want[r.doc_id][4]


def test_sites_of_pages(spark, sf_dir):
    """Hosts and paths of real URLs: many sparse ones, which shrink towards the global mean."""
    docs, labels, pages = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels", "pages"))
    model = classifier.fitted(classifier.featured(docs, "source", "lang"), labels)
    sites = classifier.page_documents(pages)
    assert sites.where("host = '' OR text LIKE '%<%>%'").count() == 0 and sites.select("host", "path").distinct().count() > 5
    table = classifier.featured(sites, "host", "path")
    rows = [(r.doc_id, r.host, r.path, r.s) for r in table.select("doc_id", "host", "path", model.score().alias("s")).collect()]
    want = brute_posteriors(rows, model.prior)
    got = classifier.posteriors(table, model).collect()
    assert len(got) == pages.count() and all(tuple(r)[1:5] == pytest.approx(want[r.doc_id][:4], abs=1e-6) for r in got)


def test_classifier_edges(spark, edge, empty, edge_rows):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (99, 0)], "doc_id long, quality int")
    assert classifier.classify(edge, labels).count() == len(edge_rows)
    assert classifier.classify(edge, labels.limit(0)).where("quality_p IS NULL").count() == 0
    assert classifier.classify(empty, labels).count() == 0
