import hashlib
import json
import math
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curlew.llm import embedding_dedup, mixing, pii, quality, topk, toxicity

VECTORS = "label int, embedding array<float>, vec_id long, rep long"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(120, 16))
    near = base[:40] + rng.normal(size=(40, 16)) * 0.08
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(np.concatenate([base, near, base[:10], 3 * base[5:8]]))]
    out = [(1, v, i, 9) for i, v in rows]
    out += [(1, None, 500, 9), (1, [], 501, 9), (1, [0.0] * 16, 502, 9), (1, [float("nan")] + [1.0] * 15, 503, 9), (1, [None] + [1.0] * 15, 504, 9), (1, [float("inf")] + [1.0] * 15, 550, 9), (1, [1.0, 2.0], 600, 9), (1, [2.0, 4.0], 601, 9), (1, [1.0] * 16, None, 9)]
    return out


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def test_embedding_dedup_is_brute_force(spark, vectors):
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(vectors, VECTORS).repartition(3), tile=64).collect()}
    assert len(got) == len(vectors)
    usable = {i: np.array(v, float) for _, v, i, _ in vectors if i is not None and good(v) and any(v)}
    links = {i: {j for j, w in usable.items() if j != i and len(w) == len(v) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.95} for i, v in usable.items()}
    for _, _, i, _ in vectors:
        if i is None:
            assert got[i]["component_id"] is None and got[i]["n_links"] == 0
            continue
        seen, todo = {i}, [i]
        while todo:
            new = links.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (len(links.get(i, ())), min(seen), min(seen) == i)
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_cells_where_they_rule_out_pairs(spark):
    """Clusters keep cells of their own, random vectors don't; doubles and floats give all links either way."""
    rng = np.random.default_rng(6)
    clustered = np.concatenate([c + rng.normal(size=(60, 24)) * 0.02 for c in rng.normal(size=(5, 24))])
    loose = rng.normal(size=(300, 24))
    for x, kind in ((clustered, "double"), (clustered.astype(np.float32), "float"), (loose, "double")):
        unit = embedding_dedup.unit(x.astype(float))
        _, meets = embedding_dedup.visits(unit, unit[:6], 0.95)
        if x is loose:
            assert meets.mean() > embedding_dedup.WORTH
        rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"vec_id long, embedding array<{kind}>").repartition(3)
        got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(rows, tile=48).collect()}
        near = unit @ unit.T >= 0.95
        assert got == {i: int(near[i].sum()) - 1 for i in range(len(x))}


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(1)
    x = embedding_dedup.unit(rng.normal(size=(200, 70)))
    q, s, e = embedding_dedup.quantise(x)
    bound = (1 + e)[:, None] * e + e[:, None] * (1 + e) + e[:, None] * e
    assert (np.abs(embedding_dedup.products(q, q) * s[:, None] * s - x @ x.T) <= bound).all()


def test_top_k_is_brute_force(spark, vectors):
    got = {}
    for r in topk.top_k(spark.createDataFrame(vectors, VECTORS).repartition(3), query_every=10, slab=50, chunk=8).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    rows = {i: [math.floor(256 * x) for x in v] for _, v, i, _ in vectors if i is not None and good(v)}
    for i, q in rows.items():
        if i % 10:
            continue
        best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in rows.items() if j != i and len(v) == len(q))[:5]
        assert got.pop(i, {}) == {n + 1: (j, -s) for n, (s, j) in enumerate(best)}
    assert not got and topk.top_k(spark.createDataFrame([], VECTORS)).count() == 0


def test_blocks_are_pruned_where_bounds_tell():
    x = np.repeat(np.eye(8) * 100, 256, axis=0)
    x[:, 0] += 1
    ids = np.arange(len(x))
    *_, scored = topk.search_slab(ids, x, np.array([-1]), x[600:601], 5)
    assert scored == 1


def test_poisson_counts(spark):
    rows = spark.range(4000).select("id", mixing.poisson_inverse(mixing.uniform(F.lit(1), F.col("id")), F.lit(2.5)).alias("k")).toPandas()
    assert abs(rows.k.mean() - 2.5) < 0.12 and abs(rows.k.var() - 2.5) < 0.3
    import hashlib

    for i, k in rows.head(50).itertuples(index=False):
        u = int(hashlib.md5(f"1:{i}".encode()).hexdigest()[:13], 16) / 16**13
        total, term, n = math.exp(-2.5), math.exp(-2.5), 0
        while total <= u:
            n += 1
            term *= 2.5 / n
            total += term
        assert n == k


def test_poisson_counts_of_large_means(spark):
    """Inversion where exp(-mean) is no double: mean and variance are the mean, and single counts are right."""
    for mean in (499.0, 501.0, 745.0, 1000.0, 20000.0):
        u = spark.range(3000).select(mixing.uniform(F.lit(5), F.col("id")).alias("u"))
        n = np.array([r[0] for r in u.select(mixing.poisson_inverse(F.col("u"), F.lit(mean))).collect()], float)
        assert abs(n.mean() / mean - 1) < 4 / math.sqrt(mean * 3000) + 1e-9 and abs(n.var() / mean - 1) < 0.15, (mean, n.mean(), n.var())
    logs = lambda mean, k: -mean + k * math.log(mean) - math.lgamma(k + 1)
    for mean in (600.0, 5000.0):
        for q in (1e-9, 0.1, 0.5, 0.9, 1 - 1e-9):
            total, k = 0.0, max(0, int(mean - 12 * math.sqrt(mean)))
            while True:
                total += math.exp(logs(mean, k))
                if total > q:
                    break
                k += 1
            assert spark.range(1).select(mixing.poisson_inverse(F.lit(q), F.lit(mean))).first()[0] == k


def test_mixing_refuses_its_own_names(spark, docs):
    for name in ("copy", "mix_key", "Copy"):
        with pytest.raises(ValueError, match="rename"):
            mixing.replicate(docs.withColumn(name, F.lit(1)))


def test_mixing_meets_its_weights(spark, docs, no_docs):
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.lit("x" * 10).alias("text"), F.lit(1).alias("rate"))
    out = mixing.replicate(rows, weights={"a": 3.0, "b": 1.0}).groupBy("source").count().toPandas().set_index("source")["count"]
    assert abs(out["a"] / out.sum() - 0.75) < 0.02 and abs(out.sum() / 6000 - 1) < 0.05
    assert mixing.replicate(docs).columns == [*docs.columns, "copy", "mix_key"] and mixing.replicate(docs).filter("source is null").count() > 0
    assert mixing.replicate(no_docs).count() == 0


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def test_pseudonyms(spark, docs, no_docs):
    from datetime import date

    text = "mail heon.19@mail5.example.com, card 4111 1111 1111 1111 bad 4111111111111112 ip 233.233.171.252. day 2024-02-29 and 31/12/1999, 30.02.2001 ssn 123-45-6789 000-12-3456 tel +49 (30) 1234-5678 iban GB82WEST12345698765432 end"
    rows = [(1, text, 5), (2, None, 5), (3, "", 5), (4, "4111-1111-1111-1111 2024-02-29 4111 1111 1111 1111", 5)]
    got = {r["doc_id"]: r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string, n_card int"), "key").collect()}
    new = got[1]["text"]
    assert [got[1][f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 2, 1, 1, 1] and got[2]["text"] is None and got[3]["text"] == "" and got[2]["n_card"] == 0
    import re

    pattern = r"mail [a-z]{4}\.\d\d@mail5\.example\.com, card (\d{4} \d{4} \d{4} \d{4}) bad 4111111111111112 ip (\d+\.\d+\.\d+\.\d+)\. day (\d{4}-\d\d-\d\d) and (\d\d/\d\d/\d{4}), 30\.02\.2001 ssn \d{3}-\d\d-\d{4} 000-12-3456 tel \+49 \(\d\d\) \d{4}-\d{4} iban (GB\d\d[A-Z]{4}\d{14}) end"
    m = re.fullmatch(pattern, new)
    assert m and luhn(m[1]) and all(int(x) < 256 for x in m[2].split(".")) and date.fromisoformat(m[3])
    moved = m[5][4:] + m[5][:4]
    assert int("".join(str(int(c, 36)) for c in moved)) % 97 == 1
    assert got[4]["text"] == f"{m[1].replace(' ', '-')} {m[3]} {m[1]}"  # equal values stay linked
    other = pii.pseudonymise(spark.createDataFrame(rows[:1], "doc_id long, text string, n_card int"), "other key").first()["text"]
    assert other != new
    assert pii.pseudonymise(docs, "key").count() == docs.count() and pii.pseudonymise(no_docs, "key").count() == 0


def test_cards_beside_other_numbers(spark):
    """A security code, an expiry or numbers before it don't hide a card."""
    card = "4111 1111 1111 1111"
    texts = [f"{card} 123", "4111111111111111 12/27", "12 4111111111111111", f"12 34 56 {card}", f"{card} 2024-02-29", "4111-1111-1111-1111-123", f"{'1234 ' * 40}{card}", "x4111111111111111", "41111111111111112222222", f"1 {card} 12ab"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r for r in pii.pseudonymise(rows, "key").orderBy("doc_id").collect()]
    for x, r in enumerate(got):
        hidden = x not in (7, 8)
        assert (r["n_card"] >= 1) == hidden and ((card in r["text"] or "4111111111111111" in r["text"] or "4111-1111-1111-1111" in r["text"]) != hidden), texts[x]
        assert len(r["text"]) == len(texts[x]) and r["n_date"] == (x == 4)


def plain_feistel(symbols, moduli, key, back=False):
    """The network of pii.feistel in plain Python, forth and back."""
    state, n = list(symbols), len(symbols)
    half = n // 2
    for r in range(pii.ROUNDS - 1, -1, -1) if back else range(pii.ROUNDS):
        other = state[half:] if r % 2 == 0 else state[:half]
        digest = hashlib.sha512(":".join([key, str(r), str(n), ".".join(map(str, other))]).encode()).hexdigest()
        stream = [int(digest[8 * i : 8 * i + 8], 16) for i in range(16)]
        for i in range(half) if r % 2 == 0 else range(half, n):
            state[i] = (state[i] + (-1 if back else 1) * stream[i % 16]) % moduli[i]
    return state


def test_pseudonyms_are_the_plain_network_and_can_be_undone(spark):
    rng = np.random.default_rng(2)
    cards, phones, names = [], [], []
    for _ in range(40):
        body = rng.integers(0, 10, int(rng.integers(12, 19))).tolist()
        check = next(c for c in range(10) if luhn("".join(map(str, [*body, c]))))
        cards.append("".join(map(str, [*body, check])))
        phones.append("+49" + "".join(map(str, rng.integers(0, 10, 9))))
        names.append("".join(rng.choice(list("abcxyzABZ0189"), int(rng.integers(2, 9)))) + "@example.com")
    rows = spark.createDataFrame([(i, "; ".join(x)) for i, x in enumerate(zip(cards, phones, names, strict=True))], "doc_id long, text string")
    got = [r["text"].split("; ") for r in pii.pseudonymise(rows, "key").orderBy("doc_id").collect()]
    first = lambda c: 48 if c.isdigit() else 65 if c.isupper() else 97
    for card, phone, name, (c, p, n) in zip(cards, phones, names, got, strict=True):
        digits, ten = [int(x) for x in card[:-1]], [10] * (len(card) - 1)
        assert plain_feistel(digits, ten, "key:card") == [int(x) for x in c[:-1]] and luhn(c)
        assert plain_feistel([int(x) for x in c[:-1]], ten, "key:card", back=True) == digits
        assert p[:3] == phone[:3] and plain_feistel([int(x) for x in p[3:]], [10] * (len(p) - 3), "key:phone", back=True) == [int(x) for x in phone[3:]]
        own, new = name.split("@")[0], n.split("@")[0]
        moduli = [10 if x.isdigit() else 26 for x in own]
        assert plain_feistel([ord(x) - first(x) for x in new], moduli, "key:email", back=True) == [ord(x) - first(x) for x in own] and list(map(first, own)) == list(map(first, new))


def test_short_names_and_national_numbers(spark):
    texts = ["write to j@example.com or j@example.com, k@example.com and 7@example.org", "_@example.com", "call 555-234-7713 or (555) 234-7713 now, 0151 23456789", "+1 (217) 555-7713 12 and +1 217 555 7713", "version 123-456-7890 of 1.2.3.4 and 2024-02-29, 0151 2345", "555-234-7713-99 and 12 555 234 7713"]
    got = [r for r in pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "key").orderBy("doc_id").collect()]
    mails = [w.strip(",") for w in got[0]["text"].split() if "@" in w]
    assert got[0]["n_email"] == 4 and mails[0] == mails[1] != mails[2] and mails[0][0] not in "jk" and mails[0][0].isalpha() and mails[3][0].isdigit() and mails[3][0] != "7"
    assert (got[1]["text"], got[1]["n_email"]) == (texts[1], 0)
    assert got[2]["n_phone"] == 3 and "234-7713" not in got[2]["text"] and "23456789" not in got[2]["text"] and len(got[2]["text"]) == len(texts[2])
    digits = lambda t: "".join(c for c in t if c.isdigit())
    ends = got[3]["text"].split(" and ")
    assert got[3]["n_phone"] == 2 and ends[0].endswith(" 12") and digits(ends[0])[:-2] == digits(ends[1])
    assert got[4]["n_phone"] == 0 and got[5]["text"] == texts[5]


def test_pseudonyms_are_a_permutation(spark):
    ips = spark.range(3000).select(F.concat_ws(".", F.lit("10"), F.floor(F.col("id") / 200), F.lit("7"), F.col("id") % 200).alias("text"))
    assert pii.pseudonymise(ips, "k").select("text").distinct().count() == 3000
    days = spark.range(4000).select(F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    out = pii.pseudonymise(days, "k")
    assert out.select("text").distinct().count() == 4000 and out.agg(F.sum("n_date")).first()[0] == 4000


def labelled(n):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        words = rng.choice(vocab, rng.integers(30, 120)).tolist()
        bad, toxic = rng.random() < 0.3, rng.random() < 0.25
        if bad:
            words = [w + "!!" for w in words]
        if toxic:
            for _ in range(5):
                words[rng.integers(len(words))] = rng.choice(["moron", "scum", "idiot"])
        out.append((i, " ".join(words), 0 if bad else int(rng.integers(1, 3)), int(toxic)))
    return out


@pytest.fixture(scope="module")
def rated(spark):
    rows = labelled(900)
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows] + [(5000, ""), (5001, None)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows] + [(None, 1, 1), (5000, None, None), (9999, 0, 0)], "doc_id long, quality int, toxic int")
    return docs.cache(), labels, {r[0]: r for r in rows}


def test_ordinal_regression(spark, rated, docs, no_docs):
    rows, labels, truth = rated
    got = {r["doc_id"]: r for r in quality.score(rows, labels, fit_rows=500).collect()}
    assert len(got) == 902 and got[5000]["expected_grade"] == got[5001]["expected_grade"]
    right = [(got[i]["tail_probability"] >= 0.5) == (r[2] >= 1) for i, r in truth.items()]
    assert np.mean(right) > 0.95 and all(0 <= r["expected_grade"] <= 2 for r in got.values())
    assert quality.score(docs, labels.limit(0), keep=("source", "n")).columns == ["doc_id", "expected_grade", "tail_probability", "source", "n"]
    assert quality.score(no_docs, labels.limit(0)).count() == 0


def test_thresholds_are_in_order():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 4, 300)
    rows = np.arange(300)
    w, edges = quality.fit_ordinal(rows, y.astype(np.int64), np.ones(300), y, 4, steps=80)
    assert (np.diff(edges) > 0).all() and (np.diff(w[:4]) > 0).all()


def test_ordinal_fit_works_in_blocks_of_whole_rows():
    import tracemalloc

    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 3000)
    rows = np.repeat(np.arange(3000, dtype=np.int32), np.where(np.arange(3000) % 7 == 0, 0, 800))
    buckets = np.where(rng.random(len(rows)) < 0.5, y[rows], rng.integers(2, 5000, len(rows))).astype(np.int32)
    shares = np.full(len(rows), 0.04, np.float32)
    tracemalloc.start()
    w, edges = quality.fit_ordinal(rows, buckets, shares, y, 2, steps=20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert w[1] > 0 > w[0] and len(edges) == 1
    assert peak < 8 * len(rows)  # less than one array of as many numbers as there are features
    assert not quality.fit_ordinal(rows[:0], buckets[:0], shares[:0], y, 2, steps=2)[0].any()



def test_toxicity(spark, rated, docs, no_docs):
    rows, labels, truth = rated
    got = {r["doc_id"]: r for r in toxicity.toxicity(rows, labels).collect()}
    assert len(got) == 902
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in truth)
    assert np.mean([got[i]["predicted"] == truth[i][3] for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    # labels of held-out rows are never read
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity.toxicity(rows, flipped).collect()}
    assert all(abs(again[i] - got[i]["score"]) < 1e-9 for i in again)
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0} and toxicity.toxicity(no_docs, labels.limit(0)).count() == 0


def counted(spark, rows, parts=4):
    """(text, code) rows -> what _meet gives."""
    grams = spark.createDataFrame(rows, "text string, code int").repartition(parts).mapInArrow(toxicity._count(16), toxicity.GRAMS)
    return grams.repartition(3, "bucket").mapInArrow(toxicity._meet(16), toxicity.MET).collect()


def spelled(text):
    """The symbols of a text's words, from the mark of the begin to the end."""
    for word in text.split(" "):
        yield [toxicity.BEGIN, *(int(toxicity.SYMBOL[b]) for b in word.encode()), toxicity.END]


def code_of(symbols):
    return sum(s << 6 * (len(symbols) - 1 - x) for x, s in enumerate(symbols))


def test_toxicity_counts_are_plain_counts(spark):
    """However the documents are split, and with or without the fold of the map."""
    rng = np.random.default_rng(5)
    words = ["vile", "pair", "extraordinarily", "extraordinary", "Ñu", "a"]
    rows = [(" ".join(rng.choice(words, 12).tolist()), int(rng.integers(0, 4))) for _ in range(300)]
    plain = {}
    for text, mark in rows:
        for symbols in spelled(text):
            for x in range(1, len(symbols)):
                key = code_of(symbols[max(0, x + 1 - toxicity.ORDER) : x + 1])
                plain.setdefault(key, [0] * 4)[mark] += 1
    got, ends = {}, {}
    for r in counted(spark, rows):
        if r["kind"] == 0:
            keys, counts = np.frombuffer(r["grams"], np.uint64), np.frombuffer(r["counts"], np.int64).reshape(-1, 4)
            got |= dict(zip(keys.tolist(), counts.tolist(), strict=True))
        elif r["kind"] == 2:
            old = ends.get(r["key"], (0, 0))
            ends[r["key"]] = (old[0] + r["x"], old[1] + r["y"])
    assert got == plain
    assert max(sum(n) for n in plain.values()) > 255
    want = {}
    limit = 64**toxicity.SHARED
    for key, n in plain.items():
        for v, own in enumerate((sum(n), n[0] + n[1])):
            want.setdefault(key % limit, [0, 0])[v] += own if key < limit else bool(own)
    assert {k: tuple(v) for k, v in want.items()} == ends


def test_toxicity_model_is_the_plain_formula(spark):
    """Evidence of words by tables = interpolated Kneser-Ney over plain dictionaries; broadcast and joined answers agree."""
    from curlew.llm.workspace import Workspace

    rng = np.random.default_rng(3)
    words = ["than", "other", "mother", "smother", "extraordinarily", "scum", "vile", "a", "ing"]
    rows = [(i, " ".join(rng.choice(words[: 9 if i % 3 else 6], 15).tolist()), int(i % 3 == 0)) for i in range(90)]
    docs = spark.createDataFrame([(i, t + " unseen words") for i, t, _ in rows], "doc long, text string").repartition(4)
    learned = spark.createDataFrame([(i, t, 1) for i, t, _ in rows], "doc long, text string, part int").repartition(4)
    labels = spark.createDataFrame([(i, x) for i, _, x in rows], "doc long, toxic int")

    def padded(symbols, x):
        return tuple(([0] * toxicity.ORDER + symbols[: x + 1])[-toxicity.ORDER :])

    def ends(table, n):
        """Continuation counts; grams that are no longer than the end keep their counts."""
        out = {}
        for gram, times in table.items():
            out[gram[-n:]] = out.get(gram[-n:], 0) + (times if not any(gram[:-n]) else 1)
        return out

    def interpolated(table, gram, below):
        off = toxicity.discounts([sum(v == r for v in table.values()) for r in range(1, 5)])
        same = [n for g, n in table.items() if g[:-1] == gram[:-1] and n]
        if not same:
            return below
        n = table.get(gram, 0)
        return (n - off[min(n, 3)] + sum(off[min(x, 3)] for x in same) * below) / sum(same)

    counts = ({}, {})
    for i, text, toxic in rows:
        for symbols in spelled(text):
            for x in range(1, len(symbols)):
                if zlib.crc32(str(i).encode()) % 5:
                    gram = padded(symbols, x)
                    counts[toxic][gram] = counts[toxic].get(gram, 0) + 1
    levels = [ends({g: counts[0].get(g, 0) + counts[1].get(g, 0) for g in counts[0] | counts[1]}, toxicity.SHARED)]
    for n in range(toxicity.SHARED - 1, 0, -1):
        levels.append(ends(levels[-1], n))

    def word_evidence(symbols):
        total = 0.0
        for x in range(1, len(symbols)):
            gram, below = padded(symbols, x), 1 / 64
            for n, level in enumerate(reversed(levels), 1):
                below = interpolated(level, gram[-n:], below)
            p = [interpolated(counts[c], gram, below) for c in (0, 1)]
            total += math.log(p[1] / p[0])
        return total

    told = lambda head, x: pa.table({"doc": head.column("doc"), "x": pa.array(list(x), pa.list_(pa.float64()))})
    values = {w: word_evidence(next(spelled(w))) for w in [*words, "unseen", "words"]}
    for most in (1 << 20, 10):
        model, _ = toxicity.learn(learned, labels, Workspace(spark, "toxicity-test"), most=most)
        assert (model.table is None) == (most == 10)
        got = {r["doc"]: r["x"] for r in model.over(docs, ["doc"], told, "doc long, x array<double>").collect()}
        for i, t, _ in rows:
            said = [values[w] for w in (t + " unseen words").split()]
            assert abs(np.mean(said) - got[i][0]) < 1e-4 and abs(max(said) - got[i][2]) < 1e-4


def test_toxicity_learns_from_every_learning_fold(spark):
    """A toxic word whose labelled examples all lie in the fold of the map is learnt."""
    rows = labelled(900)
    fold = lambda k: [i for i in range(10_000, 11_000) if zlib.crc32(str(i).encode()) % 5 == k]
    texts = [" ".join(t for t in r[1].split() if t not in ("moron", "scum", "idiot")) for r in rows[:60]]
    marked = [(i, " ".join(w if x % 6 else "vermin" for x, w in enumerate(t.split(), 1)), 1) for i, t in zip(fold(4), texts[:40], strict=False)]
    probes = [(i, " ".join(w if x % 6 else "vermin" for x, w in enumerate(t.split(), 1))) for i, t in zip(fold(0), texts[40:], strict=False)]
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows] + [(i, t) for i, t, _ in marked] + probes, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, x) for i, _, _, x in rows] + [(i, x) for i, _, x in marked], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(docs, labels).collect()}
    assert np.mean([got[i] for i, _ in probes]) > 0.9


def test_pipeline_stages_keep_the_columns(spark, tmp_path, docs):
    import corpus_pipeline as p

    rows = docs.select("doc_id", "text", "lang", "source", F.length("text").alias("n_chars")).filter("doc_id is not null").dropDuplicates(["doc_id"])
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(r["doc_id"], int(x % 9 > 0)) for x, r in enumerate(rows.select("doc_id").orderBy("doc_id").collect())]
    spark.createDataFrame(labels, "doc_id long, quality int").withColumn("toxic", F.lit(0)).write.parquet(str(tmp_path / "labels.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for name, stage in p.STAGES:
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        seen.append(now)
        if name != p.STAGES[-1][0]:
            assert now.columns == list(p.COLUMNS)
    groups = {r["doc_id"] for r in seen[1].collect()}
    assert len(groups) == seen[1].count() <= seen[0].count() and {r["doc_id"] for r in seen[3].collect()} <= groups
    assert seen[4].select("doc_id", "copy").distinct().count() == seen[3].count()


def plain_poisson(u, mean):
    term, total, k = math.exp(-mean), math.exp(-mean), 0
    while total <= u:
        k += 1
        term *= mean / k
        total += term
    return k


def test_pipeline_is_its_plain_stages(spark, tmp_path, texts):
    """Null ids, repeated rows and ids, null, empty and long texts, extra columns with clashing names: each stage on its input
    against plain loops."""
    import base64
    from collections import Counter, defaultdict

    import corpus_pipeline as p
    from test_text_operators import SECRETS, components, shingles

    from curlew.llm import packing, secret_scan

    rows = [(i, t, "en", ["s1", "s2", None][x % 3], None if t is None else len(t), x, "c", x, x) for x, (i, t) in enumerate(texts)]
    rows += [(i, t, "de", "s9", 1, 0, "c", 0, 0) for i, t in ((7, SECRETS + " " + texts[0][1]), (7, "another text of the id seven"), (None, texts[0][1]), (None, texts[0][1]), (8, SECRETS), (8, SECRETS))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, copy long, mix_key string, doc long, h long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    ids = sorted({r[0] for r in rows if r[0] is not None})
    spark.createDataFrame([(i, int(x % 9 > 0), 0) for x, i in enumerate(ids)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    now, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in p.STAGES:
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        seen.append([tuple(r) for r in now.collect()])
    # 1: what stays are whole rows of documents, judged by their text
    assert not Counter(seen[0]) - Counter(r[:5] for r in rows) and {r[1] for r in seen[0]}.isdisjoint({r[1] for r in rows} - {r[1] for r in seen[0]})
    # 2: one row of each group, all of null ids
    sets = defaultdict(list)
    for r in seen[0]:
        if r[0] is not None:
            sets[r[0]].append(shingles(r[1]))
    keyed = {(i, x): own for i, several in sets.items() for x, own in enumerate(several)}
    number = {k: n for n, k in enumerate(sorted(keyed))}
    found = components({number[k]: own for k, own in keyed.items()})
    parent = {n: n for n in found}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    back = {n: k for k, n in number.items()}
    for n, c in [*found.items(), *((number[(i, x)], number[(i, 0)]) for i, x in keyed)]:
        x, y = top(n), top(c)
        parent[max(x, y)] = min(x, y)
    stay = {back[top(n)][0] for n in found}
    assert sorted(r[0] for r in seen[1] if r[0] is not None) == sorted(stay)
    assert not Counter(seen[1]) - Counter(seen[0]) and Counter(r for r in seen[1] if r[0] is None) == Counter(r for r in seen[0] if r[0] is None)
    # 3: findings are replaced
    encode = secret_scan.encoder({base64.b64decode(a): int(b) for a, b in (line.split() for line in open(secret_scan.VOCABULARY, "rb"))})

    def clean(r):
        text = r[1]
        if text is None:
            return r
        base, out, done = secret_scan.base_spans(text), [], 0
        for s, k, e in sorted(base + secret_scan.random_spans(text, encode, base, secret_scan.RATIO)):
            if s >= done:
                out += [text[done:s], f"[{secret_scan.KINDS[k]}]"]
            done = max(done, e)
        text = "".join([*out, text[done:]])
        return (r[0], text, r[2], r[3], len(text))

    assert Counter(seen[2]) == Counter(clean(r) for r in seen[1])
    # 4: each row as often as its source's rate and its id's number say
    sizes = Counter()
    for r in seen[2]:
        sizes[r[3]] += len(r[1] or "")
    weight = {s: n**mixing.TEMPERATURE for s, n in sizes.items()}
    rate = {s: sum(sizes.values()) * weight[s] / sum(weight.values()) / n if n else 1.0 for s, n in sizes.items()}
    draw = lambda i: int(hashlib.md5(f"17:{'null' if i is None else i}".encode()).hexdigest()[:13], 16) / 16**13
    want = Counter()
    for r in seen[2]:
        want[r] += plain_poisson(draw(r[0]), rate[r[3]])
    assert Counter(seen[3]) == +want
    # 5: pieces cover every token once, in bins that hold them
    pieces = [dict(zip(("doc_id", "copy", "piece", "piece_start", "n_tokens", "shard", "bin", "bin_start"), r, strict=True)) for r in seen[4]]
    packing.check(iter(pieces), packing.CAPACITY)
    covered = Counter()
    for x in pieces:
        covered[x["doc_id"]] += x["n_tokens"]
    tokens = Counter()
    for r in seen[3]:
        tokens[r[0]] += len((r[1] or "").split())
    assert +covered == +tokens and {x["shard"] for x in pieces} == {0}
    assert len({x["bin"] for x in pieces if x["bin"] is not None}) >= sum(tokens.values()) / packing.CAPACITY


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline as p

    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, copy int")
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert p.run(spark, str(tmp_path)).count() == 0
    for _, stage in p.STAGES[:-1]:
        assert stage(spark, empty, str(tmp_path)).columns == list(p.COLUMNS)


def test_entry_lists_the_operators():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 11)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_vocabulary_is_not_in_the_repository():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert not [f for _, _, files in os.walk(os.path.join(root, "curlew")) for f in files if f.endswith((".tiktoken", ".model"))]
    assert json.dumps(root)
