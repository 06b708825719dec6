"""The corpus pipeline against a plain version of its five stages, row by row; fingerprints and base spans by value; and
every numbered query's schema."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers as public
import pytest
import xxhash

import corpus_pipeline
from carelake.llm import oracle, pii, queries, simhash
from carelake.llm.common import ship

SMALL = "/root/testdata/sf0.001"
SPACE = "\x20\x09-\x0d"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def by_sql(docs, sql, columns):
    con = duckdb.connect()
    con.register("documents", docs)
    return con.sql(f"SELECT {columns} FROM ({sql})").fetchall()


def quality_rules(docs):
    kept = {i for i, k in by_sql(docs, oracle.OP3, "doc_id, kept") if k}
    return docs[docs.doc_id.isin(kept)]


def line_key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))


def line_dedup(docs):
    holders = defaultdict(set)
    for i, text in zip(docs.doc_id, docs.text):
        for line in text.split("\n"):
            if len(line_key(line)) >= 20:
                holders[line_key(line)].add(i)
    last = {k: max(ids) for k, ids in holders.items() if len(ids) >= 3}
    keep = lambda i, t: "\n".join(x for x in t.split("\n") if last.get(line_key(x), i) == i)
    return docs.assign(text=[keep(i, t) for i, t in zip(docs.doc_id, docs.text)])


def fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(f"[^{SPACE}]+", low)
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def components(ids, prints):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for (a, x), (b, y) in itertools.combinations(zip(ids, prints), 2):
        if (x ^ y).bit_count() <= 2:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return {i: find(i) for i in ids}


def simhash_dedup(docs):
    ids = docs.doc_id.tolist()
    root = components(ids, [fingerprint(t) for t in docs.text])
    return docs[[root[i] == i for i in ids]]


def mix_sources(docs):
    out = []
    taken = dict(by_sql(docs, oracle.OP4, "doc_id, taken"))
    for i, text in zip(docs.doc_id, docs.text):
        words = re.findall(f"[{SPACE}]*[^{SPACE}]+", text)
        whole, rest = divmod(taken[i], len(words)) if words else (0, 0)
        out += [(i, text)] * whole + [(i, "".join(words[:rest]))] * (rest > 0)
    return out


def byte_bpe(rows):
    import base64

    import tiktoken

    with open(public.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    codec = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, text in rows:
        ids = np.array(codec.encode_ordinary(text), "<u4").tobytes()
        yield i, ids, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_run_equals_the_plain_stages(spark, tmp_path):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    rnd = random.Random(2)
    line = "This very line of more than twenty letters is shared"
    words = [f"word{i}" for i in range(400)]
    body = " ".join(rnd.choices(words, k=300))
    extra = [f"{line}\n{' '.join(rnd.choices(words, k=40))}" for _ in range(4)]
    extra += [body, body, f"{body} tail", "  " + body.upper(), "too short", "#$%&| " * 40]
    top = int(docs.doc_id.max()) + 1
    more = pd.DataFrame({"doc_id": range(top, top + len(extra)), "text": extra, "lang": "en", "source": ["src0", None] * 5,
                         "n_chars": [len(t) for t in extra]})
    docs = pd.concat([docs, more], ignore_index=True)
    docs.to_parquet(tmp_path / "documents.parquet")
    plain = simhash_dedup(line_dedup(quality_rules(docs)))
    want = Counter(byte_bpe(mix_sources(plain)))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = Counter((r[0], bytes(r[1]), *r[2:]) for r in got.collect())
    assert rows == want
    # each stage acts: documents rejected, lines and near copies dropped, some repeated
    assert len(quality_rules(docs)) < len(docs) and len(plain) < len(quality_rules(docs)) and max(want.values()) > 1


def test_fingerprints_by_value(spark):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")[["doc_id", "text"]].head(120)
    odd = pd.DataFrame({"doc_id": [10**6 + i for i in range(6)], "text": [None, "", "Ä É", "one two", "A\x0bB\tc D\x1ce", "x " * 500]})
    docs = pd.concat([docs, odd], ignore_index=True)
    rows = [(int(i), t) for i, t in zip(docs.doc_id, docs.text)]
    g = simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.hex, r.component_id) for r in g.withColumn("hex", simhash.hex_of(g.fp)).collect()}
    prints = {i: fingerprint(t) for i, t in rows}
    root = components(list(prints), list(prints.values()))
    assert got == {i: (f"{p:016x}", root[i]) for i, p in prints.items()}
    assert got[10**6][0] == got[10**6 + 1][0] == "0" * 16


def luhn(digits):
    d = [int(c) for c in reversed(digits)]
    return sum(d[0::2]) % 10 + sum(sum(divmod(2 * x, 10)) for x in d[1::2]) % 10


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s)) % 10 == 0),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15),
    }
    kinds = list(rules)
    found = [(m.start(), kinds.index(k), k, m.end()) for k, (p, ok) in rules.items() for m in re.finditer(p, text) if ok(m[0])]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def test_base_spans_by_plain_patterns():
    rnd = random.Random(4)
    bits = ["a.b+c", "@", "mail.example.com", "x-y", "1", "23", "456", ".", "255.1.2.3", "300.1.1.1", "4111 1111 1111 1111",
            "4111-1111-1111-1112", "+1 (469) 555-3334", "+44", "(0)", " ", " ", "-", "\n", "é", "5105105105105100", "%", "_"]
    for _ in range(4000):
        text = "".join(rnd.choices(bits, k=rnd.randint(0, 14)))
        got = [(kind, start, end) for kind, start, end in pii.base_spans(text)]
        assert got == plain_spans(text), text


CONTRACTS = {
    "op1": ["doc_id", "fingerprint", "component_id"],
    "op2": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op3": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op4": ["doc_id", "size", "source_size", "target", "taken"],
    "op5": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op6": ["doc_id", "n_words", "log_likelihood", "mean_log_likelihood"],
    "op7": ["doc_id", "held_out", "score", "predicted"],
    "op8": ["query_id", "rank", "vec_id", "score"],
    "op9": ["doc_id", "held_out", "lang_pred", "score"],
    "op10": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
}


@pytest.mark.parametrize("op", CONTRACTS)
def test_numbered_queries_return_their_columns_for_every_row(spark, op):
    name, query = next((n, q) for n, q in queries.queries().items() if n.startswith(f"{op}_"))
    got = query(spark, SMALL)
    assert got.columns == CONTRACTS[op], name
    if op != "op8":
        want = pd.read_parquet(f"{SMALL}/documents.parquet").doc_id.tolist()
        assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(want)
    else:
        ids = pd.read_parquet(f"{SMALL}/embeddings.parquet").vec_id
        assert {r[0] for r in got.select("query_id").collect()} == {int(i) for i in ids if i % 20 == 0}
