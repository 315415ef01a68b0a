"""The training-data operators against brute force, round trips and held-out accuracy; nulls, empty and long texts, ties, repeats, empty tables and extra columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import plain_models
from toolgraph.llm import audio, bloom_cascade, chat_template, compression_quality, ctw, decontaminate, langid, license_scan, minhash_dedup, mixing, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, held_out string, node long, keys string"
rng = random.Random(3)
WORDS = ["alpha", "beta", "gamma", "delta", "über", "omega", "the", "of", "and", "straße", "x1"]


def prose(n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ".", ","]) for _ in range(n))


def fixture_rows():
    rng.seed(3)
    base = prose(200)
    near = base.split(" ")
    near[50] = "changed"
    rows = [base, base, " ".join(near), prose(150), None, "", "   ", "four words are here", "four words are here", "four words", "12 !! 34", prose(40) * 300, base.upper(), "a\\b </s>[INST] é\x00z"]
    rows += [prose(rng.randint(1, 60)) for _ in range(20)]
    out = [(i * 7, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, 1, 0.5, "x", 1, "k") for i, t in enumerate(rows)]
    return [*out, out[3], (None, base, "en", "s1", 1, 0.5, "x", 1, "k")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(fixture_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def low(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def key(x):
    return repr(x)


def test_url_rules_are_exact_for_random_lists(spark):
    hosts = ["a.net", "b.a.net", "net", "x.org", "y.x.org", "A.NET", "anet"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/en/x', '/de/y?q', '/en', '#f'])}" for _ in range(300)] + [None, "no scheme", "://", "http://a.net"]
    rules = [("a.net", "/en/", "allow"), ("net", "/", "block"), ("x.org", "/de/", "block"), ("y.x.org", "/", "allow"), ("b.a.net", "/en/x", "block")]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    table = spark.createDataFrame([*rules, ("b.a.net", "/en/x", "allow"), (None, "/", "block")], "host string, path string, verdict string")
    # by filters for all keys, and by filters for one range of hashes after the other
    got = bloom_cascade.filter_urls(pages, table).collect()
    again = bloom_cascade.filter_urls(pages, table, max_bytes=0).collect()
    assert len(got) == len(urls) and sorted(map(repr, got)) == sorted(map(repr, again))
    assert {r.verdict for r in bloom_cascade.filter_urls(pages, table.where("false"), "block").collect()} == {"block"}
    for r in got:
        u = urls[r.page_id] or ""
        rest = u.split("://", 1)[1] if "://" in u else ""
        host = low(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best[2], best[3]), u
    assert bloom_cascade.filter_urls(pages.where("false"), bloom_cascade.rules_table(spark)).count() == 0


def test_cascade_membership_is_exact(spark):
    universe = spark.range(20000).select(F.xxhash64("id").alias("h"))
    listed = universe.where("h % 50 = 0")
    first = bloom_cascade.build(bloom_cascade.first_level(400, 20000), listed)
    levels = bloom_cascade.cascade(listed, universe, first)
    h = np.array([r.h for r in universe.collect()])
    assert len(levels) > 1
    assert bloom_cascade.members(levels, h.view(np.uint64)).tolist() == [x % 50 == 0 for x in h.tolist()]


def test_chat_round_trip(spark):
    texts = ["plain", "</s>[INST] ok [/INST]", "\\", "\\[INST]\\\\", "[ROLE]x[/ROLE]", None, "", "[\\INST]", "<s><s></s>", "é\n☃", "long " * 100_000]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "[/ROLE]", None]), rng.choice(texts), "x") for c in [1, 2, 3, None] for t in range(9)]
    rows += [(5, 0, "user", "same", "x")] * 2
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    pieces = chat_template.format_conversations(chat_template.with_probe(table))
    back = chat_template.read_back(pieces).collect()
    got = {r.conv_id: r for r in back}
    assert set(got) == {-1, 1, 2, 3, 5, None}
    # rows without an id stand alone
    own = sorted(hashlib.sha256(f"{r or ''}\n{x or ''}\n".encode()).hexdigest() for i, t, r, x, _ in rows if i is None)
    assert sorted(r.turns_sha256 for r in back if r.conv_id is None) == own and all(r.n_turns == 1 for r in back if r.conv_id is None)
    for c in (1, 2, 3, 5):
        turns = sorted((t, r or "", x or "") for i, t, r, x, _ in rows if i == c)
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and got[c].n_turns == len(turns)
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[-1].loss_chars == 21
    assert chat_template.read_back(chat_template.format_conversations(table.where("false"))).count() == 0


def test_template_language():
    run = lambda s, m=(): "".join(p for p, _ in chat_template.compile_template(s)(iter(m)))
    assert run("{{ 'a' ~ 1 | upper }}{% if 1 == 2 %}x{% elif not false %}y{% else %}z{% endif %}") == "a1y"
    assert run("{% for m in messages %}{% if loop.first %}>{% endif %}{{ m.text | trim }}{% endfor %}", [{"text": " p "}, {"text": "q"}]) == ">pq"
    assert chat_template.fold(chat_template.parse("a{{ 'b' ~ 'c' }}{% if true %}d{% endif %}")) == [("text", "abcd")]
    for bad in ("{{ m.__class__ }}", "{{ f() }}", "{% import os %}", "{% for m in messages %}", "{{ x | shell }}"):
        with pytest.raises(chat_template.TemplateError):
            chat_template.compile_template(bad)


def test_lm_base_scores_and_split(spark, docs, nothing):
    rows = fixture_rows()
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", low(r[1])) + ["\0end"] for r in rows]
    held = [zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 10 == 0 for r in rows]
    c = Counter(t for ts, h in zip(tokens, held, strict=True) if not h for t in ts)
    n, v = sum(c.values()), len(c)
    want = sorted((key(r[0]), h, len(t), sum(c[x] > 0 for x in t), n, round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t), 6)) for r, t, h in zip(rows, tokens, held, strict=True))
    for limit in (10**6, 0):
        got = ctw.lm_scores(docs, ctw.crc_mod(F.col("doc_id"), 10) == 0, limit=limit).collect()
        assert sorted((key(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
        assert all(r.score < 0 for r in got)
    assert ctw.documents_scored(nothing).count() == 0


def test_lm_model_is_a_distribution():
    text = (b"abracadabra " * 50 + b"the cat sat on the mat " * 30)
    grams = Counter()
    depth, buf = 3, b"\0\0\0" + text
    tables = [{} for _ in range(depth + 1)]
    for i in range(depth, len(buf)):
        for d in range(depth + 1):
            context = int.from_bytes(buf[i - d : i], "big")
            tables[d].setdefault(context, np.zeros(256, np.int64))[buf[i]] += 1
    grams.clear()
    total = len(text)
    kept = [tables[0], *({c: t for c, t in x.items() if t.sum() * 40 >= total} for x in tables[1:])]
    for d in range(2, depth + 1):  # a node's parent is a node too
        kept[d] = {c: t for c, t in kept[d].items() if c & ((1 << 8 * (d - 1)) - 1) in kept[d - 1]}
    model = plain_models.Model(kept, depth)
    assert np.allclose((10.0 ** model.logp).sum(axis=1), 1, atol=1e-4)
    again = np.frombuffer(buf, np.uint8)
    assert -model.score(again, np.arange(3, len(again))).sum() / math.log10(2) / total < 1.5


def plain_ctw(texts, depth, least):
    """The definition, context by context: (context, decision node) -> counts, and the probability of a one."""
    counts = {}
    for t in texts:
        buf = b"\0" * depth + t + b"\0"
        for i in range(depth, len(buf)):
            for d in range(depth + 1):
                node = 1
                for k in range(7, -1, -1):
                    bit = buf[i] >> k & 1
                    counts.setdefault((buf[i - d : i], node), [0, 0])[bit] += 1
                    node = 2 * node + bit

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def kids(c):
        below = (bytes([x]) + c for x in range(256))
        return [x for x in below if sum(counts.get((x, 1), (0, 0))) >= least] if len(c) < depth else []

    def rest(c, node):
        a, b = counts.get((c, node), (0, 0))
        return a - sum(counts.get((x, node), (0, 0))[0] for x in kids(c)), b - sum(counts.get((x, node), (0, 0))[1] for x in kids(c))

    def log_sums(c, node):
        return sum(log_w(x, node) for x in kids(c)) + kt(*rest(c, node))

    def log_w(c, node):
        est = kt(*counts.get((c, node), (0, 0)))
        return est if len(c) == depth else float(np.logaddexp(est, log_sums(c, node))) - math.log(2)

    def one(context, node, d):
        c = context[len(context) - d :]
        a, b = counts.get((c, node), (0, 0))
        here = (b + 0.5) / (a + b + 1)
        if d == depth:
            return here
        est, sums = kt(a, b), log_sums(c, node)
        a, b = rest(c, node)
        deeper = one(context, node, d + 1) if context[len(context) - d - 1 :] in kids(c) else (b + 0.5) / (a + b + 1)
        share = 1 / (1 + math.exp(min(700, max(-700, sums - est))))
        return share * here + (1 - share) * deeper

    def score(t):
        buf, total = b"\0" * depth + t + b"\0", 0.0
        for i in range(depth, len(buf)):
            node = 1
            for k in range(7, -1, -1):
                bit = buf[i] >> k & 1
                p = one(buf[i - depth : i], node, 0)
                total += math.log10(p if bit else 1 - p)
                node = 2 * node + bit
        return total

    return score


def test_lm_scores_are_those_of_a_plain_context_tree(spark):
    texts = ["abracadabra abra", "cadabra", "", "aaaa", "Abra\u00fc", "zq"]
    learnt = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 10]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for depth, least in ((2, 2), (3, 1), (1, 3)):
        want = plain_ctw([low(texts[i]).encode() for i in learnt], depth, least)
        got = {r.doc_id: r.score for r in ctw.lm_scores(rows, ctw.crc_mod(F.col("doc_id"), 10) == 0, depth, least).collect()}
        for i, t in enumerate(texts):
            assert math.isclose(got[i], want(low(t).encode()), rel_tol=1e-6), (depth, least, t)


def test_lm_contexts_are_kept_by_their_own_count(spark, docs, monkeypatch):
    rows = fixture_rows()
    held = [zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 10 == 0 for r in rows]
    depth, bufs = ctw.DEPTH, [b"\0" * ctw.DEPTH + low(r[1]).encode() + b"\0" for r in rows]
    tables = [{} for _ in range(depth + 1)]
    for buf, h in zip(bufs, held, strict=True):
        for i in range(depth, 0 if h else len(buf)):
            for d in range(depth + 1):
                tables[d].setdefault(int.from_bytes(buf[i - d : i], "big"), np.zeros(256, np.int64))[buf[i]] += 1
    model = plain_models.Model([tables[0], *({c: t for c, t in x.items() if t.sum() >= 2} for x in tables[1:])], depth)
    want = sorted((key(r[0]), len(b), model.score(np.frombuffer(b, np.uint8), np.arange(depth, len(b))).sum()) for r, b in zip(rows, bufs, strict=True))
    for limit, size in ((10**6, 0), (0, 1 << 12), (0, 1 << 30)):
        monkeypatch.setattr(ctw, "GROUP_BYTES", size or ctw.GROUP_BYTES)
        got = sorted((key(r.doc_id), r.n_bytes + 1 + depth, r.score) for r in ctw.lm_scores(docs, ctw.crc_mod(F.col("doc_id"), 10) == 0, limit=limit).collect())
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-3, atol=0.01)


def test_language_id(spark, docs, nothing):
    got = langid.documents_identified(docs).collect()
    rows = Counter(map(key, (r[0] for r in fixture_rows())))
    assert Counter(key(r.doc_id) for r in got) == rows
    by = {r.doc_id: r for r in got}
    assert all(by[i * 7].lang_pred == "und" and by[i * 7].score == 0 for i in (4, 5, 6, 10)) and by[0].lang_pred == "en"
    assert langid.documents_identified(nothing).count() == 0
    table = spark.read.parquet(f"{SF}/documents.parquet")
    judged = langid.documents_identified(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in judged) >= 0.95 * len(judged)


def test_language_proportions_are_those_of_plain_em(spark):
    """One text at a time, trigrams as byte strings in dictionaries."""
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = [(r.doc_id, r.text, r.lang) for r in table.collect()]
    extra = [(10**6, next(t for _, t, x in rows if x == "de")[:900] + " " + next(t for _, t, x in rows if x == "fr")[:900], None), (10**6 + 1, "Qx", None)]

    judged = plain_models.language_mixtures([(t, x) for i, t, x in rows if zlib.crc32(str(i).encode()) % 4 != 2])
    rows += extra
    got = {r.doc_id: r for r in langid.documents_identified(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for i, t, _ in [*rows[:40], *extra]:
        want = judged(t)
        assert set(got[i].languages) == {x for x, v in want.items() if v > 0}
        assert all(math.isclose(got[i].languages[x], v, abs_tol=1e-3) for x, v in want.items())
        assert got[i].lang_pred == max(want, key=lambda x: want[x])
    assert got[10**6].languages.keys() == {"de", "fr"}


def test_mixture_finds_two_languages(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    parts = {r.lang: r.text for r in table.where("n_chars > 1500").groupBy("lang").agg(F.min("text").alias("text")).collect()}
    mixed = spark.createDataFrame([(10**6, parts["de"][:1500] + " " + parts["es"][:1500], None)], "doc_id long, text string, lang string")
    held = F.col("doc_id") == 10**6
    r = langid.identify(table.select("doc_id", "text", "lang").unionByName(mixed), held).where(held).first()
    assert set(r.languages) >= {"de", "es"} and r.score < 0.7


def brute_components(rows):
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root(i), []).append(r[0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted((key(r[0]), len(sets[i]), key(least[root(i)] if sets[i] else r[0])) for i, r in enumerate(rows))


def test_near_duplicates(spark, docs, nothing, monkeypatch):
    want = brute_components(fixture_rows())
    got = sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in minhash_dedup.near_duplicates(docs).collect())
    assert got == want
    assert minhash_dedup.near_duplicates(nothing).count() == 0
    # crowded buckets: chains of texts that drift apart, by leaders
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(words[: 60 + i % 40] + [f"z{i % 7}"]), "en") for i in range(90)]
    monkeypatch.setattr(minhash_dedup, "SMALL", 3)
    monkeypatch.setattr(minhash_dedup, "LEADERS", 4)
    got = sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect())
    assert got == brute_components(rows)
    # crowded buckets whose members share several passages, with other texts of their own around them
    r = random.Random(11)
    passages = [[f"p{k}_{i}" for i in range(30)] for k in range(4)]
    rows = []
    for i in range(80):
        own = [f"o{r.randrange(4)}_{j}" for j in range(r.choice([4, 12, 20, 40]))]
        rows.append((i, " ".join(sum((p for p in passages if r.random() < 0.8), []) + own), "en"))
    got = sorted((key(x.doc_id), x.n_shingles, key(x.component_id)) for x in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect())
    assert got == brute_components(rows)


def test_crowd_of_texts_that_nearly_link_makes_few_pairs(spark, monkeypatch):
    """Copies with a few words changed, most of them just too far apart: what the leaders' join lets through is near the links, not all pairs."""
    r = random.Random(21)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(160):
        words = base[:]
        for at in r.sample(range(150), r.choice([3, 4])):
            words[at] = f"o{i}_{at}"
        rows.append((i, " ".join(words), "en"))
    kept, whole = [], minhash_dedup.materialise

    def counted(df, name):
        out = whole(df, name)
        if name == "candidates":
            kept.extend((x.u, x.v) for x in out.collect())
        return out

    monkeypatch.setattr(minhash_dedup, "SMALL", 3)
    monkeypatch.setattr(minhash_dedup, "materialise", counted)
    got = sorted((key(x.doc_id), x.n_shingles, key(x.component_id)) for x in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect())
    assert got == brute_components(rows)
    sets = [shingles(x[1]) for x in rows]
    close = sum(len(a & b) >= 0.73 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert 0 < len(set(kept)) <= close


def test_parity_discards_no_link():
    r = np.random.default_rng(8)
    for size in (1, 7, 70, 700, 7000):
        for _ in range(30):
            a = np.unique(r.integers(0, 2**63, size, dtype=np.uint64))
            same = a[: len(a) - r.integers(0, len(a) // 4 + 1)]
            b = np.unique(np.concatenate([same, r.integers(0, 2**63, r.integers(0, size // 4 + 1), dtype=np.uint64)]))
            x, y = minhash_dedup.sketch_set(a)[2], minhash_dedup.sketch_set(b)[2]
            flips = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64).tolist())
            both = len(np.intersect1d(a, b))
            assert flips <= len(a) + len(b) - 2 * both
            assert 100 * both < 75 * (len(a) + len(b) - both) or flips * 7 <= len(a) + len(b)


def test_near_duplicates_by_distributed_steps(spark, docs, monkeypatch):
    """The ways for many edges, many pairs, and digests that share 64 bits."""
    from toolgraph.llm import components

    monkeypatch.setattr(components, "FEW_EDGES", -1)
    monkeypatch.setattr(minhash_dedup, "FEW_PAIRS", -1)
    monkeypatch.setattr(minhash_dedup, "PART", 7)
    monkeypatch.setattr(minhash_dedup, "SMALL", 3)
    monkeypatch.setattr(minhash_dedup, "LEADERS", 4)
    whole = minhash_dedup._id
    monkeypatch.setattr(minhash_dedup, "_id", lambda sig, turn: whole(sig, turn) if turn else F.pmod(whole(sig, turn), F.lit(9)))
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(words[: 60 + i % 20] + [f"z{i % 3}"]), "en") for i in range(40)] + [(100 + i, t, "en") for i, (_, t, *_) in enumerate(fixture_rows())]
    got = sorted((key(r.doc_id), r.n_shingles, key(r.component_id)) for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect())
    assert got == brute_components(rows)


def test_components_both_ways(spark, monkeypatch):
    from toolgraph.llm import components

    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 540)]
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    want = {x: root[x] for e in edges if e[0] != e[1] for x in e}
    for few in (10**6, -1):
        monkeypatch.setattr(components, "FEW_EDGES", few)
        table = spark.createDataFrame(edges, "u long, v long")
        assert {x.node: x.component for x in components.components(table).collect()} == want
        assert components.components(table.where("false")).count() == 0


def test_one_of_each_group_keeps_null_and_reused_ids_apart(spark):
    r = random.Random(5)
    a, b, c, d, e = (" ".join(f"{x}{r.randrange(10**6)}" for _ in range(60)) for x in "abcde")
    near = a.replace(a.split(" ")[30], "changed")
    # a: the least id; b and c: two texts without id; d and e: two texts of id 7, of which d has a copy with a lesser id
    rows = [(1, a), (2, near), (None, a), (None, b), (None, b), (None, c), (7, d), (7, e), (7, e), (3, d), (None, ""), (None, None), (9, " "), (9, "\n")]
    for parts in (1, 3):
        got = minhash_dedup.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts))
        assert got.columns == ["doc_id", "text"]
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [(1, a), (None, b), (None, c), (3, d), (7, e), (None, ""), (None, None), (9, " "), (9, "\n")]))


def test_odd_sketches_follow_similarity():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 2**63, 1000, dtype=np.uint64))
    counts = []
    for same in (950, 860, 300):
        b = np.unique(np.concatenate([a[:same], r.integers(0, 2**63, 1000 - same, dtype=np.uint64)]))
        x, y = minhash_dedup.sketch_set(a)[1], minhash_dedup.sketch_set(b)[1]
        counts.append(sum(int(v).bit_count() for v in (x ^ y).view(np.uint64).tolist()))
    assert counts[0] < counts[1] <= minhash_dedup.XOR_LIMIT and counts[1] < counts[2]


def test_license_scan(spark, docs, nothing):
    text = prose(80) + "\nReleased under the MIT License.\n" + prose(30) + " Licensed under the APACHE license, version 2.0! " + prose(9)
    table = spark.createDataFrame([(1, text, 0.0), (2, None, 0.0), (3, prose(300), 0.0), (4, "Released under the GIT license", 0.0)], "doc_id long, text string, coverage double")
    got = sorted(license_scan.scan_licenses(table).collect(), key=lambda r: (r.doc_id, r.start_byte))
    assert [(r.doc_id, r.license) for r in got if r.coverage == 1] == [(1, "MIT"), (1, "Apache-2.0")]
    assert text.encode()[got[0].start_byte : got[0].end_byte] == b"Released under the MIT License"
    assert all(r.doc_id != 3 for r in got)
    assert license_scan.scan_licenses(docs).count() == 0 and license_scan.scan_licenses(nothing).count() == 0


def test_license_scan_finds_edited_notices(spark):
    """Of every template with one word changed, dropped or added all are found; with two words changed nine of ten, by brute-force alignment."""
    r = random.Random(2)
    texts, reach = [], []
    for name, t in license_scan.TEMPLATES.items():
        w = t.split(" ")
        for i in range(len(w)):
            texts += [" ".join(["zz yy", *x, "xx ww"]) for x in ([*w[:i], "zork", *w[i + 1 :]], [*w[:i], *w[i + 1 :]], [*w[:i], "zork", *w[i:]])]
        for _ in range(4):
            x = list(w)
            for i in r.sample(range(len(x)), 2):
                x[i] = "zork"
            own, theirs = (re.findall(r"[a-z0-9]+", low(y)) for y in (t, " ".join(x)))
            row = [0] * (len(own) + 1)  # longest common subsequence
            for word in theirs:
                row = [0, *(max(a, b, c + (word == o)) for a, b, c, o in zip(new_row(row, own, word), row[1:], row, own, strict=False))]
            if row[-1] >= license_scan.COVERAGE * len(own):
                reach.append((len(texts), name))
            texts.append(" ".join(["zz yy", *x, "xx ww"]))
    got = {x.doc_id for x in license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()}
    single = set(range(len(texts))) - {i for i, t in enumerate(texts) if t.count("zork") == 2}
    assert single <= got and sum(i in got for i, _ in reach) >= 0.9 * len(reach)
    assert license_scan.scan_licenses(spark.createDataFrame([(0, "a b c")], "doc_id long, text string"), {}).count() == 0


def new_row(row, own, word):
    out, left = [], 0
    for j, o in enumerate(own):
        out.append(left)
        left = max(left, row[j + 1], row[j] + (word == o))
    return out


def test_license_scan_reports_notices_repeated_close_by(spark):
    mit, cc = "Released under the MIT License.", "Licensed under CC BY 4.0."
    texts = [f"{mit} {mit}", f"{cc} and so {cc}", f"{cc} {mit} " * 40, f"{mit} {mit} {mit} {cc} {cc}"]
    got = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for i, t in enumerate(texts):
        want = sorted((m.start(), m.end() - 1, name) for name, x in (("MIT", mit), ("CC-BY-4.0", cc)) for m in re.finditer(re.escape(x), t))
        assert sorted((r.start_byte, r.end_byte, r.license) for r in got if r.doc_id == i) == want


def test_license_scan_names_the_licences_that_the_repository_knows(spark):
    from toolgraph.functions import licenses

    known = {re.sub("-(only|or-later)$", "", x) for x in licenses.SPDX}
    assert known - set(license_scan.TEMPLATES) == {"CECT-1.0"}
    names = sorted(license_scan.TEMPLATES)
    table = spark.createDataFrame([(i, f"zzz {license_scan.TEMPLATES[n]} zzz") for i, n in enumerate(names)], "doc_id long, text string")
    got = license_scan.scan_licenses(table).collect()
    assert sorted((r.doc_id, r.license, r.coverage) for r in got) == [(i, n, 1.0) for i, n in enumerate(names)]
    gpl2 = license_scan.TEMPLATES["GPL-3.0-notice"].replace("version 3", "version 2")
    got = license_scan.scan_licenses(spark.createDataFrame([(0, gpl2), (1, "Licensed under CC BY-SA 4.0")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license) for r in got) == [(0, "GPL-2.0-notice"), (1, "CC-BY-SA-4.0")]


def test_budgets_redistribute_among_siblings_first():
    leaves = {("a", "x", "1"): 10, ("a", "x", "2"): 1000, ("a", "y", "1"): 1000, ("b", "x", "1"): 1000}
    got = plain_models.budgets(leaves, {("a",): 1.0, ("b",): 1.0}, 800, 1)
    assert got == {("a", "x", "1"): 10, ("a", "x", "2"): 190, ("a", "y", "1"): 200, ("b", "x", "1"): 400}


def test_budgets_in_closed_form(spark):
    r = random.Random(8)
    for _ in range(4):
        leaves = {(f"d{r.randrange(3)}", r.choice("xyz"), f"s{i % 7}"): r.choice([1, 5, 40, 900, 20_000]) for i in range(r.choice([1, 12, 30]))}
        weights = {("d0",): 3.0, ("d1",): 0.0, ("d0", "x"): 5.0, ("d2", "y"): 0.5, ("d0", "x", "s1"): 9.0}
        table = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, held long")
        for share, epochs in ((0.5, 2), (3.0, 2), (0.01, 1)):
            got = {(x.domain, x.lang, x.source): x.budget for x in mixing.plan(table, weights, share, epochs).collect()}
            want = plain_models.budgets(leaves, weights, share * sum(leaves.values()), epochs)
            assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def brute_mix(rows, share, max_epochs):
    """rows: (doc_id, domain, lang, source, n_tokens)."""
    leaves = Counter()
    for r in rows:
        leaves[r[1:4]] += r[4]
    leaves = {k: v for k, v in leaves.items() if v}
    out = []
    for leaf, budget in plain_models.budgets(leaves, mixing.WEIGHTS, share * sum(leaves.values()), max_epochs).items():
        if not budget:
            continue
        epochs, rest = divmod(budget, leaves[leaf])
        before = 0
        digest = lambda r, e=epochs: hashlib.md5(f"{mixing.SEED}:{e}:{'' if r[0] is None else r[0]}".encode()).hexdigest()
        for r in sorted((r for r in rows if r[1:4] == leaf), key=lambda r: (digest(r), -1 if r[0] is None else r[0], r[4])):
            copies = epochs + (before < rest)
            before += r[4]
            if copies:
                out.append((key(r[0]), *r[1:], copies))
    return sorted(out)


def mix_rows(rows):
    domain = lambda s: f"d{ord(hashlib.md5((s or '').encode()).hexdigest()[0]) % 3}"
    return [(r[0], domain(r[3]), r[2] or "", r[3] or "", len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in rows]


def test_mixing_takes_the_seeded_prefix(spark, docs, nothing, monkeypatch):
    got = lambda table, **k: sorted((key(r.doc_id), r.domain, r.lang, r.source, r.n_tokens, r.copies) for r in mixing.mix(table, mixing.WEIGHTS, **k).collect())
    assert got(docs, share=0.7, max_epochs=3) == brute_mix(mix_rows(fixture_rows()), 0.7, 3)
    # ranges split again and again; one id, without end, with two texts; null ids
    rows = [(i, "a b c " * (i % 5), "en", "s") for i in range(300)] + [(7, "x y", "en", "s"), (7, "", "en", "s")] * 900 + [(None, "q r s", "en", "s")] * 40
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for share in (0.1, 0.55, 1.0, 2.3):
        assert got(table, share=share, edge=3) == brute_mix(mix_rows(rows), share, mixing.MAX_EPOCHS)
    monkeypatch.setattr(mixing, "FEW_LEAVES", 0)
    assert got(table, share=0.55, edge=3) == brute_mix(mix_rows(rows), 0.55, mixing.MAX_EPOCHS)
    assert mixing.mix(nothing, mixing.WEIGHTS).count() == 0 and mixing.mix(docs.where("text is null"), mixing.WEIGHTS).count() == 0


def test_media_round_trip(spark, docs, nothing):
    import pyarrow as pa

    rows = {r.doc_id: r for r in audio.media_columns(docs).collect()}
    for i, t, *_ in fixture_rows():
        data = (t or "").encode()
        payload = data + b" " * (max(192, -(-len(data) // 192) * 192) - len(data))
        r = rows[i]
        assert r.n_bytes == len(data) and audio.samples_of(bytes(r.media)).tobytes() == payload
        table = pa.ipc.open_stream(bytes(r.tensors)).read_all()
        assert table.schema.field("log_mel").type.shape == [16, 20] and table.num_rows >= 1
        assert all(0 <= s.start_s < s.end_s for s in r.segments)
    assert audio.media_columns(nothing).count() == 0
    t = np.arange(12000) / 12000
    y = audio.resample(np.sin(2 * np.pi * 440 * t).astype(np.float32))
    assert len(y) == 8000 and abs(int(np.argmax(np.abs(np.fft.rfft(y)))) - 440) <= 1


def plain_log_mel(payload):
    """Every step from its definition: interpolation by phases, frames, a Hann window, the DFT as a sum, triangles on the mel scale."""
    x = np.array(list(payload)) / 128 - 1
    taps = audio.UP * audio.TAPS
    n = np.arange(taps) - (taps - 1) / 2
    h = np.sinc(n / 3) * np.hanning(taps + 2)[1:-1]
    h = [h[p :: audio.UP] / h[p :: audio.UP].sum() for p in range(audio.UP)]
    y = []
    for k in range(-(-len(x) * audio.UP // audio.DOWN)):
        at, phase = divmod(k * audio.DOWN, audio.UP)
        y.append(sum(h[phase][j] * x[i] for j in range(audio.TAPS) if 0 <= (i := at + audio.TAPS // 2 - 1 - j) < len(x)))
    count = max(1, -(-(len(y) - audio.FRAME) // audio.HOP) + 1)
    y += [0.0] * (audio.FRAME + count * audio.HOP)
    t = np.arange(audio.FRAME)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * t / (audio.FRAME - 1))
    freq = np.arange(audio.FRAME // 2 + 1) * 8000 / audio.FRAME
    edges = 700 * (10 ** (np.linspace(2595 * np.log10(1 + 60 / 700), 2595 * np.log10(1 + 4000 / 700), audio.MELS + 2) / 2595) - 1)
    out = []
    for f in range(count):
        frame = np.array(y[f * audio.HOP : f * audio.HOP + audio.FRAME]) * window
        power = [abs((frame * np.exp(-2j * np.pi * k * t / audio.FRAME)).sum()) ** 2 for k in range(len(freq))]
        bands = [sum(p * max(0, min((q - a) / (b - a), (c - q) / (c - b))) for p, q in zip(power, freq, strict=True)) for a, b, c in zip(edges, edges[1:], edges[2:], strict=False)]
        out.append([math.log(b + 1e-6) for b in bands] + [math.log(sum(power) + 1e-6)])
    return np.array(out)


def test_media_features_are_those_of_a_plain_dft(spark):
    import pyarrow as pa

    texts = ["", "The quick brown fox, ünd so on. " * 20, "\x01\x7f" * 150 + " " * 700 + "zzzz" * 90]
    for r in audio.media_columns(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        want = plain_log_mel(bytes(r.samples))
        table = pa.ipc.open_stream(bytes(r.tensors)).read_all()
        got = np.concatenate([np.array(x).reshape(16, 20) for x in table.column("log_mel").combine_chunks().storage.to_pylist()])
        assert np.allclose(got[: len(want)], want[:, :20], atol=1e-3) and not got[len(want) :].any()
        # hysteresis frame by frame
        energy, on, spans = np.round(want[:, 20] * 1024) / 1024, False, []
        mean, high = energy.mean(), energy.mean() + 0.5 * energy.std()
        for f, e in enumerate(energy):
            was, on = on, (e > high or (on and not e < mean))
            if on and not was:
                spans.append([f, f])
            elif on:
                spans[-1][1] = f
        assert [(x.start_s, x.end_s) for x in r.segments] == [(a * 128 / 8000, (b * 128 + 256) / 8000) for a, b in spans]


def test_quality_scores_are_those_of_text_by_text_compression(spark):
    table, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = compression_quality.crc_mod(F.col("doc_id"), 3) == 1
    model = compression_quality.learn(table.select("doc_id", "text"), labels, held)
    # nothing but the text and the model
    sizes = []
    for r in compression_quality.documents_rated(table, labels).join(table.select("doc_id", "text"), "doc_id").collect():
        x = plain_models.difference(model, r.text)
        assert math.isclose(r.score, 1 / (1 + math.exp(-model["a"] - model["b"] * x)), rel_tol=1e-6) and r.predicted == (r.score >= 0.5)
        sizes.append(x)
    assert len(sizes) == table.count()
    # ids repeat with other texts, in any order of rows: one model
    again = table.select("doc_id", "text").unionByName(table.select("doc_id", F.lit("another text of this id").alias("text")))
    models = [compression_quality.learn(again.repartition(n), labels, held) for n in (1, 5)]
    assert models[0] == models[1]


def test_quality(spark, docs, nothing):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    no_labels = labels.where("false")
    assert all(r.score == 0.5 and r.predicted == 1 for r in compression_quality.documents_rated(docs, no_labels).collect())
    assert compression_quality.documents_rated(nothing, labels).count() == 0
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = compression_quality.documents_rated(table, marks).join(marks, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in judged) >= 0.9 * len(judged) and all(0 <= r.score <= 1 for r in judged)


def brute_hits(rows, bench):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = []
    for item, t in bench:
        w = word.findall(low(t))
        windows += [(item, w[i : i + 13]) for i in range(max(1, len(w) - 12))] if w else []
    for i, t, *_ in rows:
        w = word.findall(low(t))
        hit, items = set(), set()
        for item, x in windows:
            for a in range(len(w) - len(x) + 1):
                if w[a : a + len(x)] == x:
                    hit |= set(range(a, a + len(x)))
                    items.add(str(item))
        yield key(i), len(w), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(w)


def test_decontamination(spark, docs, nothing):
    rows = fixture_rows()
    bench = [(1, rows[0][1]), (2, "Über Straße"), (3, None), (4, "!!"), (5, prose(30)), (10, " ".join(rows[3][1].split(" ")[20:33])), (11, "x1")]
    table = spark.createDataFrame([(*b, "c") for b in bench], "item_id long, text string, words string")
    want = sorted(brute_hits(rows, bench), key=repr)
    for size in (16 << 20, 0):
        got = decontaminate.judge(docs, table, broadcast_bytes=size).collect()
        assert sorted(((key(r.doc_id), r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got), key=repr) == want
    assert decontaminate.judge(nothing, table).count() == 0
    assert not any(r.contaminated for r in decontaminate.judge(docs, table.where("false")).collect())
    kept = decontaminate.clean(docs, table)
    assert kept.columns == docs.columns and kept.count() == sum(not w[4] for w in want)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, name):
    import duckdb

    db = duckdb.connect()
    for t in "documents benchmark pages conversations".split():
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), db.sql(queries.ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda f: sorted((tuple(None if v is None or v != v else v for v in r) for r in f[columns].itertuples(index=False)), key=repr)
    assert rows(got) == rows(want)


def test_ties(spark):
    # two languages learnt from the same texts, and two templates of the same words
    texts = ["one two three four five six seven " * 5, "alpha beta gamma delta " * 9]
    rows = [(10 * i + j, t, x) for i, t in enumerate(texts) for j, x in enumerate(["b", "a"])] + [(1000 + i, texts[0], None) for i in range(8)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.col("doc_id") >= 1000).where("held_out").collect()
    assert {r.lang_pred for r in got} == {"a"}
    twins = {"Z-long": "you may copy this file for any use at all but sell it", "B": "copy this file for any use", "A": "Copy this file, for any use!"}
    table = spark.createDataFrame([(0, "well copy this file for any use ok")], "doc_id long, text string")
    assert [(r.license, r.matched) for r in license_scan.scan_licenses(table, twins).collect()] == [("A", 6)]


def test_very_long_texts(spark):
    r = random.Random(12)
    long = " ".join(r.choice(WORDS) + str(r.randrange(5000)) for _ in range(250_000))
    text = f"{long}\nReleased under the MIT License.\n{'x' * 300_000} tail"
    table = spark.createDataFrame([(0, text), (1, "short text"), (2, None)], "doc_id long, text string")
    found = license_scan.scan_licenses(table).collect()
    assert [(x.doc_id, x.license, x.start_byte) for x in found] == [(0, "MIT", len(f"{long}\n".encode()))]
    media = {x.doc_id: x for x in audio.media_columns(table).collect()}
    assert bytes(media[0].samples).rstrip(b" ") == text.encode() and len(media[0].media) == len(media[0].samples) + 44
    scored = {x.doc_id: x for x in ctw.lm_scores(table, F.col("doc_id") == 1).collect()}
    assert scored[0].n_tokens == 250_000 + 5 + 2 + 1 and scored[0].n_bytes == len(text.encode()) and math.isfinite(scored[0].score)
    pages = spark.createDataFrame([(0, "http://a.net/" + "p/" * 500_000), (1, "http://" + "a." * 2_000 + "net/x")], "page_id long, url string")
    assert {(x.page_id, x.rule) for x in bloom_cascade.filter_urls(pages, bloom_cascade.rules_table(spark)).collect()} == {(0, "net/"), (1, "net/")}


CLASHING = "text_key string, bad_id long, kept_id string, key int, kept_key int, node long, component string, held_out string, score string, good int, order int, place string, prefix int"


@pytest.mark.parametrize("stage", ["language_id", "quality", "near_dedup", "decontamination", "mixing"])
def test_stages_take_any_rows(spark, stage):
    """Nulls in every column, reused ids, repeated rows, empty and very long texts, clashing column names, no rows."""
    import corpus_pipeline

    rng.seed(9)
    real = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(120).collect()]
    huge = " ".join(rng.choice(WORDS) + str(rng.randrange(3000)) for _ in range(400_000))
    odd = [(None, None, None, None, None), (None, real[0][1], None, None, None), (None, real[1][1], "en", None, 3), (real[2][0], real[3][1], "de", "src1", 1), real[4], real[4], (10**7, "", "en", "src1", 0), (10**7 + 1, " \n", None, "src2", 2), (10**7 + 2, huge, "en", "src3", len(huge))]
    base = spark.createDataFrame(real + odd, "doc_id long, text string, lang string, source string, n_chars long")
    wide = base.select("*", *(F.lit(None).cast(x.split(" ")[1]).alias(x.split(" ")[0]) for x in CLASHING.split(", ")))
    function = dict(corpus_pipeline.STAGES)[stage]
    got = function(spark, wide, SF)
    if stage == "mixing":
        assert sorted((key(r.doc_id), r.domain, r.lang, r.source, r.n_tokens, r.copies) for r in got.collect()) == brute_mix(mix_rows([(*x[:2], x[2], x[3]) for x in real + odd]), mixing.SHARE, mixing.MAX_EPOCHS)
    else:
        assert got.columns == wide.columns
        kept = Counter((r.doc_id, r.text and hashlib.md5(r.text.encode()).hexdigest()) for r in got.collect())
        had = Counter((x[0], x[1] and hashlib.md5(x[1].encode()).hexdigest()) for x in real + odd)
        assert all(n <= had[k] for k, n in kept.items())
        if stage == "near_dedup":
            assert kept[None, None] == kept[10**7, ""] == 1 and max(kept.values()) == 1
        else:  # rows are judged by their text alone
            by = {}
            for (i, t), n in had.items():
                by.setdefault(t, set()).add(kept[i, t] == n)
                assert kept[i, t] in (0, n)
            assert all(len(x) == 1 for x in by.values())
    assert function(spark, wide.where("false"), SF).count() == 0


def test_folders_of_a_stage_go(spark, tmp_path):
    from toolgraph.llm import common

    paths = []
    with common.scratch(spark):
        common.materialise(spark.range(3), "a")
        out, path = common.stored(spark.range(5), "b")
        paths = [p for p in __import__("os").listdir(common.shared_dir(spark)) if p.startswith(("a-", "b-"))]
    left = [p for p in __import__("os").listdir(common.shared_dir(spark)) if p in paths]
    assert len(paths) >= 2 and all(not p.startswith("a-") for p in left) and out.count() == 5
    common.remove(spark, path)


def test_pipeline(spark):
    import corpus_pipeline

    frames, table = [], spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        frames.append(table)
        table = corpus_pipeline.stored(stage(spark, table, SF), "t")[0]
    before = [{r.doc_id: r for r in f.collect()} for f in frames]
    mixture = plain_models.language_mixtures([(r.text, r.lang) for i, r in before[0].items() if r.lang and zlib.crc32(str(i).encode()) % 4 != 2])
    letters = lambda t: any(map(str.isalpha, t or ""))
    assert set(before[1]) == {i for i, r in before[0].items() if letters(r.text) and max(mixture(r.text).values()) >= 0.5}
    held, labels = compression_quality.crc_mod(F.col("doc_id"), 3) == 1, spark.read.parquet(f"{SF}/labels.parquet")
    rated = plain_models.compressed(compression_quality.learn(frames[1].select("doc_id", "text"), labels, held))
    assert set(before[2]) == {i for i, r in before[1].items() if rated(r.text) >= 0.5}
    rows = [(r.doc_id, r.text) for r in before[2].values()]
    assert {repr(i) for i in before[3]} == {c for _, _, c in brute_components(rows)}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {repr(i) for i in before[4]} == {h[0] for h in brute_hits([(r.doc_id, r.text) for r in before[3].values()], bench) if not h[4]}
    assert frames[4].columns == frames[0].columns
    want = brute_mix(mix_rows([(r.doc_id, r.text, r.lang, r.source) for r in before[4].values()]), mixing.SHARE, mixing.MAX_EPOCHS)
    assert sorted((key(r.doc_id), r.domain, r.lang, r.source, r.n_tokens, r.copies) for r in table.collect()) == want
