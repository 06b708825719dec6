"""The training-data operators on small tables: nulls, empty and long texts, repeats, empty tables, further columns, and
brute-force versions of what SQL cannot express."""

import hashlib
import itertools
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from carelake.llm import byte_bpe, language_id, line_dedup, mixing, pii, pseudo_likelihood, quality_gam, quality_rules
from carelake.llm import simhash, vp_tree
from carelake.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, fp string, k string"
LONG = "lorem ipsum dolor sit amet consectetur " * 3000


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and blank and long texts, repeated rows and ids."""
    line = "The same line of more than twenty letters"
    rows = [
        (1, "a b c d e f g h", "en", "s1", 15),
        (2, "a b c d e f g h", "en", "s1", 15),
        (2, "a b c d e f g h", "en", "s1", 15),
        (2, "other words under a used id", "en", "s2", 27),
        (3, None, None, None, None),
        (4, "", "fr", "s2", 0),
        (5, " \t\n ", "fr", "s2", 4),
        (None, f"{line}\nshort", "en", "s3", 50),
        (7, f"{line.upper()}  \nmore", "en", "s3", 50),
        (8, f" {line}\n{line}\nmore", "en", None, 90),
        (9, LONG, "en", "s1", len(LONG)),
        (10, "mail a.b@mail.example.com or +1 (469) 555-3334, 116.75.34.232 and 300.1.1.1", "en", "s1", 70),
    ]
    return table(spark, rows).cache()


def naive_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return [int(2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0 for b in range(64)]


def test_fingerprint_and_groups(spark, odd):
    got = simhash.simhash_groups(odd).collect()
    assert len(got) == odd.count()
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    bits = {t: "".join(map(str, naive_fingerprint(t))) for _, t in texts}
    assert len({r.fp for r in got}) == len({tuple(naive_fingerprint(t)) for _, t in texts}) and bits
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.component_id)
    assert by_id[1] == {1} and 1 in by_id[2] and by_id[4] == by_id[5] == by_id[3] == {3}


def test_links_equal_all_pairs(spark):
    r = np.random.default_rng(1)
    base = [int(x) for x in r.integers(-(2**63), 2**63 - 1, 40)]
    fps = {0, -1, 1, 3, 7, 15}
    for x in base:
        y = x
        for _ in range(6):
            fps.add(y)
            for b in r.integers(0, 64, int(r.integers(1, 4))):
                y ^= (1 << int(b)) if b < 63 else -(1 << 63)
    fps = sorted(fps)
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(fps, 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    edges = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"))
    from carelake.llm.components import connected_components

    got = {x.node: x.root for x in connected_components(edges).collect()}
    assert {x: got.get(x, x) for x in fps} == {x: find(x) for x in fps}


def test_keep_one(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 3 in ids and 4 not in ids and 5 not in ids and len([i for i in ids if i == 2]) == 1


def test_bpe_against_library(odd):
    tiktoken, tokens = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    path = tokens.path("byte_bpe_multi_50k.tiktoken")
    codec = byte_bpe.Codec(open(path, "rb").read(), tokens.PATTERN)
    library = tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    assert sorted(codec.whole.ranks) == sorted(codec.ranks.values()) and codec.whole.get(b"\xff\xfe no token") == -1
    for text in ["", "  a  b\n\n c", "日本語🙂 x" * 5, "it's 's 'll", "a" * 4000, "12345" * 9, "<|endoftext|>", "é́ \x85\xa0²x"]:
        assert [x[0] for x in struct.iter_unpack("<I", codec.encode(text))] == library.encode_ordinary(text)
        assert codec.decode(codec.encode(text)) == text.encode()
    got = byte_bpe.encode_documents(odd, path, tokens.PATTERN).collect()
    assert sorted((r.n_tokens, r.decoded_sha256) for r in got) == sorted(
        (len(library.encode_ordinary(r.text or "")), hashlib.sha256((r.text or "").encode()).hexdigest())
        for r in odd.collect()
    )


def test_repeated_words_brute_force():
    r = np.random.default_rng(2)
    for n in (0, 7, 8, 30, 80):
        words = [str(x) for x in r.integers(0, 2, n)]
        wins = [tuple(words[i : i + 8]) for i in range(n - 7)]
        want = {j for i, w in enumerate(wins) if wins.count(w) > 1 for j in range(i, i + 8)}
        assert quality_rules.repeated_words(words) == len(want)


def test_host_verdict_rejects_bad_host_only(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "too short", "en", "bad", 9) for i in range(40)] + [(99, good, "en", "bad", 9)]
    rows += [(100 + i, f"{good} {i}", "en", f"h{i % 4}", 9) for i in range(40)] + [(200, good, "en", None, 9)]
    docs = table(spark, rows)
    kept = {r.doc_id for r in quality_rules.keep_good(docs).collect()}
    assert kept == {200, *range(100, 140)}


def test_mix_targets_and_limits(spark):
    rows = [(i, "w " * (1 + i % 7), "en", f"s{i % 5}" if i % 6 else None, 1) for i in range(400)]
    rows += [(1000 + i, "w " * 9, "en", "s0", 1) for i in range(300)] + [(2000, None, "en", "s1", 0)]
    docs = table(spark, rows)
    got = mixing.mix(docs).toPandas()
    assert (got.taken <= 3 * got["size"]).all() and got.taken.sum() == got["size"].sum()
    by = got.groupby("skey").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert ((by.taken - by.target).abs() <= len(by)).all() and (by.target <= 3 * by["size"]).all()
    assert abs(by.target.sum() - by["size"].sum()) < 1e-6
    served = mixing.apply_mix(docs)
    assert served.columns == docs.columns
    assert served.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] == got.taken.sum()


def test_mix_divides_a_hot_id_and_many_sources(spark):
    rows = [(None, f"w x {'y ' * (i % 3)}", "en", "hot", 1) for i in range(900)]  # one null id, three texts
    rows += [(i, "w " * (1 + i % 5), "en", f"s{i:04d}", 1) for i in range(600)]  # a source for each document
    docs = table(spark, rows).repartition(5)
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sized = mixing.materialize(mixing.sized_documents(docs).withColumn("salt", F.monotonically_increasing_id()), "s")
        cut = mixing.ranged(sized, ["skey", "okey", "doc_id", "size", "tkey", "salt"], "size").select(
            "skey", "okey", "doc_id", "size", "tkey", "salt", "size_before"
        )
        upto = 0
        for r in sorted(cut.collect(), key=lambda r: (r.skey, r.okey, r.doc_id or -1, r.size, r.tkey, r.salt)):
            assert r.size_before == upto
            upto += r.size
        # nothing beyond the shuffle's share meets in a range, though 900 of 1,500 rows share an id
        share = sized.repartitionByRange("skey", "okey", "doc_id", "size", "tkey", "salt").groupBy(F.spark_partition_id())
        assert max(r["count"] for r in share.count().collect()) < 3 * 1500 / 12
        got = mixing.mix(docs).toPandas()
        again = mixing.mix(docs.repartition(3)).toPandas()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    plan = {}  # targets by plain resharing
    sizes = got.groupby("skey")["size"].sum().sort_index()
    weight = {k: 1 + i % 3 for i, k in enumerate(sizes.index)}
    rest, open_ = float(sizes.sum()), set(sizes.index)
    while True:
        level = rest / sum(weight[k] for k in open_)
        full = {k for k in open_ if weight[k] * level > 3 * sizes[k]}
        plan |= {k: 3.0 * sizes[k] for k in full}
        rest, open_ = rest - sum(3.0 * sizes[k] for k in full), open_ - full
        if not full:
            plan |= {k: weight[k] * level for k in open_}
            break
    by = got.groupby("skey").agg(target=("target", "first"), taken=("taken", "sum"))
    assert max(abs(by.target[k] - plan[k]) for k in plan) < 1e-6
    # shares are rounded up to words, so the total budget cuts the runs that finish last, of 5 words at most
    assert ((by.taken - by.target).abs() <= 5).all() and (got.taken <= 3 * got["size"]).all()
    assert got.taken.sum() == got["size"].sum()
    key = ["skey", "doc_id", "tkey", "size", "taken"]
    rows = [t[key].sort_values(key).reset_index(drop=True) for t in (got, again)]
    assert rows[0].equals(rows[1])


@pytest.mark.parametrize("stage", [simhash.keep_one, line_dedup.drop_lines, mixing.apply_mix])
def test_columns_of_helper_names_stay(odd, stage):
    names = ["key", "keep", "Size", "taken", "tkey", "copy", "words", "__key", "__keep", "__size"]
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars", *(F.lit(f"own {n}").alias(n) for n in names))
    got = stage(docs)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.select(*names).distinct().collect()} == {tuple(f"own {n}" for n in names)}


def test_line_dedup(spark, odd):
    rows = {r.doc_id: r.text for r in line_dedup.drop_lines(odd).collect() if r.doc_id in (None, 7, 8)}
    line = "The same line of more than twenty letters"
    assert rows == {None: "short", 7: "more", 8: f" {line}\n{line}\nmore"}
    assert line_dedup.drop_lines(odd).count() == odd.count()


def test_line_dedup_hot_line_over_many_partitions(spark):
    hot = "one very common line that most documents hold"
    docs = table(spark, [(i, f"{hot}\nonly in {i:030d}\n{hot}", "en", "s", 1) for i in range(300)]).repartition(7)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = {r.doc_id: r.text for r in line_dedup.drop_lines(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert all(got[i] == f"only in {i:030d}" for i in range(299)) and got[299].count(hot) == 2


def test_pseudo_likelihood_prefers_order(spark, odd):
    r = np.random.default_rng(3)
    text = lambda: " ".join(w for _ in range(60) for w in ("the", f"n{r.integers(5)}", "of", f"m{r.integers(5)}"))
    docs = table(spark, [(i, text(), "en", "s", 1) for i in range(1200)]).coalesce(1)
    top, w = pseudo_likelihood.train(docs)
    good = text().split()
    bad = [good[i] for i in r.permutation(len(good))]
    two = table(spark, [(1, " ".join(good), "en", "s", 1), (2, " ".join(bad), "en", "s", 1)])
    score = {x.doc_id: x.mean_log_likelihood for x in pseudo_likelihood.score(two, top, w).collect()}
    assert score[1] > score[2] + 0.5
    edge = {(x.doc_id, x.n_words): x.mean_log_likelihood for x in pseudo_likelihood.score(odd, top, w).collect()}
    assert edge[3, 0] is None and edge[4, 0] is None and edge[9, 18000] < 0


def test_pseudo_likelihood_does_not_hang_on_the_file_layout(spark):
    r = np.random.default_rng(7)
    text = lambda: " ".join(w for _ in range(60) for w in ("the", f"n{r.integers(5)}", "of", f"m{r.integers(5)}"))
    docs = table(spark, [(i, text(), "en", "s", 1) for i in range(1200)])
    rows = []
    for i in range(20):
        words = text().split()
        some = r.permutation(len(words))[: i * 12]
        for a, b in zip(some, r.permutation(some)):
            words[a], words[b] = words[b], words[a]
        rows.append((i, " ".join(words), "en", "s", 1))
    order = []
    for n in (1, 50):
        got = pseudo_likelihood.score(table(spark, rows), *pseudo_likelihood.train(docs.repartition(n))).collect()
        of = {x.doc_id: x.mean_log_likelihood for x in got}
        assert of[0] > of[19] + 0.5
        order.append(np.argsort(np.argsort([of[i] for i in range(20)])))
    assert np.corrcoef(*order)[0, 1] > 0.95


@pytest.mark.parametrize("held", [0, 5, 1000])
def test_pseudo_likelihood_of_each_word_in_a_shared_id(spark, monkeypatch, held):
    monkeypatch.setattr(pseudo_likelihood, "OWN_LEAST", 4)
    monkeypatch.setattr(pseudo_likelihood, "HELD", held)
    texts = [f"The of a to rare{i % 40} rare{i % 7} of" for i in range(300)]
    words, w = pseudo_likelihood.train(table(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)]))
    count = {}
    for x in " ".join(texts).lower().encode().split():
        count[x] = count.get(x, 0) + 1
    assert {bytes(r.word): r.n for r in words.counts.collect()} == count and len(words.own) > 4
    slots = len(words.shared_n)
    slot = lambda x: pseudo_likelihood.zlib.crc32(x) % slots
    rare = [x for x in count if x not in words.own]
    n = [sum(count[x] for x in rare if slot(x) == s) for s in range(slots)]
    kinds = [sum(slot(x) == s for x in rare) for s in range(slots)]
    new = [next(x for x in (f"junk{i}".encode() for i in range(999)) if slot(x) == s) for s in range(slots)]

    def share(x):
        total, mine = max(n[slot(x)] + kinds[slot(x)], 1), kinds[slot(x)] or 1
        return np.log(count.get(x, mine * slots * 257.0 ** -(len(x) + 1)) / total)

    docs = [[x, b"of", x, b"the"] for x in rare + new] + [[], rare + new]
    own = {x: i for i, x in enumerate(words.own)}
    want = {}
    for i, d in enumerate(docs):
        ids = np.array([own.get(x, words.size - slots + slot(x)) for x in d], np.int64)
        logs = pseudo_likelihood.log_probabilities(w, pseudo_likelihood.contexts(ids, words.size), ids) if d else np.zeros(0)
        want[i] = (len(d), logs.sum() + sum(share(x) for x in d if x not in own))
    rows = [(i, b" ".join(d).decode(), "en", "s", 1) for i, d in enumerate(docs)] + [(0, " ".join(x.decode() for x in docs[0]), "en", "s", 1)]
    got = pseudo_likelihood.score(table(spark, rows), words, w).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.log_likelihood) == (want[r.doc_id][0], pytest.approx(want[r.doc_id][1], abs=1e-3))
    for s in range(slots):  # in the same id, a word not in the corpus costs more than any that is
        assert all(share(x) > share(new[s]) + 10 for x in rare if slot(x) == s)


def test_pseudo_likelihood_ids_grow_with_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "OWN_LEAST", 4)
    monkeypatch.setattr(pseudo_likelihood, "PER_OWN", 1)
    of = lambda n: spark.createDataFrame([(" ".join(f"w{i * j % 997}" for j in range(50)),) for i in range(n)], "text string")
    few, many = (pseudo_likelihood.corpus_words(of(n)) for n in (20, 500))
    assert len(few.own) == 31 and len(many.own) == 158 and many.size == 14**2
    assert pseudo_likelihood.start_weights(many.size)["words"].shape == (14, pseudo_likelihood.HIDDEN, 14)


def test_gam_learns_an_interaction():
    r = np.random.default_rng(4)
    x = r.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    m = quality_gam.fit(x[:2000], y[:2000])
    assert ((m.score(x[2000:]) > 0.5) == (y[2000:] > 0.5)).mean() > 0.95
    assert quality_gam.fit(np.zeros((0, 4)), np.zeros(0)).score(x).shape == (3000,)


def test_quality_sample_of_repeated_rows_is_by_hash(spark, monkeypatch):
    monkeypatch.setattr(quality_gam, "fit", lambda x, y: (x, y))
    text = lambda i: "word " * (i + 1)
    docs = spark.createDataFrame([(i, text(i)) for i in range(60) for _ in range(3)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    by_hash = [r.doc_id for r in labels.orderBy(F.xxhash64("doc_id")).collect()][:10]
    x, y = quality_gam.train(docs, labels, most=30)
    want = sorted(tuple(quality_gam.features(text(i))) + (i % 2,) for i in by_hash for _ in range(3))
    got = sorted((*a, b) for a, b in zip(x.tolist(), y.tolist()))
    assert np.allclose(got, want)


def test_quality_scores_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (4, 0), (9, 1), (None, 0), (10, None)], "doc_id long, quality int")
    got = quality_gam.score(odd, quality_gam.train(odd, labels)).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)


def test_vp_tree_exact_and_recall(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(1500, 8))
    x[700:1000] = x[700]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(3, None), (None, [1.0] * 8), (20, [0.0] * 8), (40, [float("nan")] * 8)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = {}
    for q in range(0, 1500, 20):
        s = (x * x[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:20]
        want[q] = order
    exact, quick = {}, {}
    for out, factor in ((exact, 1.0), (quick, vp_tree.FACTOR)):
        for row in vp_tree.nearest(e, factor=factor, shard=400).orderBy("query_id", "rank").collect():
            out.setdefault(row.query_id, []).append(row.vec_id)
    assert exact == want
    assert np.mean([len({*quick[q]} & {*want[q]}) / 20 for q in want]) >= 0.9
    assert vp_tree.nearest(e.limit(0)).count() == 0


def test_forward_sums_all_segmentations():
    pieces = sorted({"▁", "▁a", "a", "b", "ab", "ba", "▁ab", "abb"})
    p = np.linspace(0.05, 0.2, len(pieces))[:, None]
    prob = dict(zip(pieces, p[:, 0]))

    def total(w):
        if not w:
            return 1.0
        return sum(prob[w[:m]] * total(w[m:]) for m in range(1, len(w) + 1) if w[:m] in prob) + language_id.UNKNOWN * total(w[1:])

    words = ["▁abba", "▁bbab", "▁zabb"]
    got = language_id.Lattice(pieces).forward(words, p)[-1][:, 0]
    assert np.allclose(got, [total(w) for w in words])
    lattice, count, step = language_id.Lattice(pieces), np.array([1.0, 2.0, 1.0]), 1e-6
    expected = lattice.expected(words, count, p)
    for i in range(len(pieces)):  # expected counts are p * d log Z / d p
        up = p.copy()
        up[i] += step
        slope = (count * (np.log(lattice.forward(words, up)[-1][:, 0]) - np.log(got))).sum() / step
        assert abs(expected[i] - p[i, 0] * slope) < 1e-3


def test_language_id_odd_rows(odd):
    pieces = sorted({"▁", *"abcdefghijklmnopqrstuvwxyz"})
    langs, p = language_id.train(odd.select("lang", "text"), pieces)
    got = language_id.predict(odd, pieces, langs, p).collect()
    und = [r.doc_id for r in got if r.lang_pred == "und"]
    assert sorted(und) == [3, 4, 5] and len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)


def test_base_spans():
    text = "a.b@x.org, c@d @e.f 1.2.3.4.5.6.7.8, 256.1.1.1, 4111 1111 1111 1111, 4111111111111112, +1 (469) 555-3334."
    got = [(k, text[s:e]) for k, s, e in pii.base_spans(text)]
    assert got == [
        ("email", "a.b@x.org"), ("ip", "1.2.3.4"), ("ip", "5.6.7.8"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (469) 555-3334"),
    ]
    assert pii.base_spans("7" * 200_000) == [] and pii.base_spans("a" * 200_000 + "@") == []


def test_tagger_learns_and_windows_agree(spark, odd):
    r = np.random.default_rng(6)
    filler = lambda n: " ".join("".join(r.choice(list("abcdefgh"), int(r.integers(2, 8)))) for _ in range(n))
    mail = lambda: f"{''.join(r.choice(list('abcdefgh'), 5))}.{r.integers(99)}@mail{r.integers(9)}.example.com"
    docs = table(spark, [(i, f"{filler(int(r.integers(1, 20)))} {mail()} {filler(9)}", "en", "s", 1) for i in range(250)])
    tagger = pii.train(docs)
    texts = [f"{filler(k)} {mail()} {filler(12)}" for k in range(30)]
    found = pii.model_spans(texts, tagger)
    hits = sum(any(k == "email" and t[s:e] == b for k, s, e in f) for t, f in zip(texts, found) for b in [t[pii.base_spans(t)[0][1] : pii.base_spans(t)[0][2]]])
    assert hits >= 24
    got = {r.doc_id: r for r in pii.find(odd, tagger).collect() if r.doc_id == 10}[10]
    assert [s.kind for s in got.base] == ["email", "phone", "ip"] and len(got.spans) >= 3
    assert pii.train(odd.where("doc_id = 1")) is None


def test_tagger_finds_spans_that_the_patterns_miss(spark):
    r = np.random.default_rng(8)
    filler = lambda n: " ".join("".join(r.choice(list("abcdefghinorst"), int(r.integers(2, 9)))) for _ in range(n))
    digits = lambda n: "".join(r.choice(list("0123456789"), n))
    name = lambda: "".join(r.choice(list("abcdefghinorst"), int(r.integers(3, 9))))

    def card():
        d = "4" + digits(14)
        return next(d + c for c in "0123456789" if pii.luhn(d + c))

    known = {
        "email": lambda: f"{name()}.{digits(2)}@mail{digits(1)}.example.com", "phone": lambda: f"+1 ({digits(3)}) 555-{digits(4)}",
        "card": card, "ip": lambda: ".".join(str(r.integers(256)) for _ in range(4)),
    }
    plain = lambda: f"{r.integers(1900, 2030)}-{r.integers(10, 13)}-{r.integers(10, 29)} {digits(3)} x{digits(5)}ef dot {digits(2)} at"
    rows = [(i, f"{filler(9)} {known[k]()} {filler(9)}", "en", "s", 1) for i, k in enumerate([*known] * 80)]
    rows += [(1000 + i, f"{filler(8)} {plain()} {filler(12)}", "en", "s", 1) for i in range(150)]
    tagger = pii.train(table(spark, rows))
    new = {
        "email": lambda: f"{name()} at {name()} dot com", "phone": lambda: f"{digits(3)}-{digits(3)}-{digits(4)}",
        "phone of 7": lambda: f"555-{digits(4)}", "card": card, "ip": lambda: known["ip"]().replace(".", "[.]"),
    }
    found, of = {}, {}
    for k in new:
        texts, at = [], []
        for _ in range(40):
            before, span = f"{filler(7)} ", new[k]()
            texts.append(f"{before}{span}{' ' + digits(16) if k == 'card' else ''} {filler(8)}")
            at.append((k.split()[0], len(before), len(before) + len(span)))
        assert not any(pii.base_spans(t) for t in texts)
        found[k] = sum(a in pii.all_spans(t, m)[1] for t, a, m in zip(texts, at, pii.model_spans(texts, tagger)))
        of[k] = len(texts)
    wrong = [t for t in (f"{filler(8)} {plain()} {filler(9)}" for _ in range(40))]
    n_wrong = sum(map(bool, pii.model_spans(wrong, tagger)))
    print("held-out spans beyond the patterns:", found, "of", of, "plain texts with a span:", n_wrong)
    assert all(found[k] >= 0.7 * of[k] for k in new) and n_wrong <= 4


@pytest.mark.parametrize(
    "run",
    [
        simhash.keep_one, quality_rules.keep_good, line_dedup.drop_lines, mixing.apply_mix,
        lambda d: quality_gam.score(d, quality_gam.Model()), lambda d: pii.find(d, None),
        lambda d: language_id.predict(d, ["a"], [], np.zeros((1, 0))),
        lambda d: pseudo_likelihood.score(d, *pseudo_likelihood.train(d)),
    ],
)
def test_empty_table(odd, run):
    assert run(odd.limit(0)).count() == 0


def test_pipeline_odd_rows(spark, odd):
    import corpus_pipeline

    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == odd.columns
    out = corpus_pipeline.byte_bpe(spark, docs, "").collect()
    assert all(len(r.ids) == 4 * r.n_tokens for r in out)
