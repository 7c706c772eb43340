"""The trained operators: normalisation, held-out quality and odd tables."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from searchlake.llm import fingerprint, lm_score, quality, toxicity
from searchlake.llm.common import WordHash

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def auc(rows, score, label):
    good = [r[score] for r in rows if r[label] == 1]
    bad = [r[score] for r in rows if r[label] == 0]
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


# --- quality ----------------------------------------------------------------------------


def plain_kneser_ney(texts):
    """Interpolated modified Kneser-Ney with dictionaries; returns p(w | u, v)."""
    from collections import Counter, defaultdict

    tri = Counter()
    for t in texts:
        own = [None, None, *quality.tokens(t.encode())]
        tri.update(zip(own, own[1:], own[2:]))
    bi = Counter((v, w) for _, v, w in tri)
    uni = Counter(w for _, w in bi)

    def discounts(counts):
        n = [sum(c == i for c in counts.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        raw = [1 - 2 * y * n[2] / n[1] if n[1] else 0.5, 2 - 3 * y * n[3] / n[2] if n[2] else 1.0, 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        d = [min(max(x, 0.05), i + 0.95) for i, x in enumerate(raw)]
        return lambda c: d[min(c, 3) - 1]

    cut1, cut2, cut3 = discounts(uni), discounts(bi), discounts(tri)

    def order(counts, cut):
        total, mass = defaultdict(int), defaultdict(float)
        for g, c in counts.items():
            total[g[:-1]] += c
            mass[g[:-1]] += cut(c)
        return total, mass

    tot1, mass1 = sum(uni.values()), sum(cut1(c) for c in uni.values())
    tot2, mass2 = order(bi, cut2)
    tot3, mass3 = order(tri, cut3)

    def p(u, v, w):
        x = mass1 / tot1 / (len(uni) + 1) + (uni[w] - cut1(uni[w])) / tot1 if w in uni else mass1 / tot1 / (len(uni) + 1)
        if (v,) in tot2:
            x = x * mass2[(v,)] / tot2[(v,)] + ((bi[v, w] - cut2(bi[v, w])) / tot2[(v,)] if (v, w) in bi else 0)
        if (u, v) in tot3:
            x = x * mass3[u, v] / tot3[u, v] + ((tri[u, v, w] - cut3(tri[u, v, w])) / tot3[u, v] if (u, v, w) in tri else 0)
        return x

    return p, uni


def test_model_equals_plain_dictionaries(spark):
    rnd = random.Random(9)
    vocab = "the cat dog sat on a mat and ran home . , !".split()
    texts = [" ".join(rnd.choice(vocab[: rnd.randrange(3, 13)]) for _ in range(rnd.randrange(1, 30))) for _ in range(80)] + ["", "one"]
    model = quality.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    p, uni = plain_kneser_ney(texts)
    for t in [*texts[:20], "the unseen dog sat", "zzz", "cat cat cat the"]:
        own = [None, None, *quality.tokens(t.encode())]
        want = [math.log(p(*own[i : i + 3])) for i in range(len(own) - 2)]
        got = model.log_probability(*quality.ngrams([own[2:]], WordHash())) if own[2:] else np.empty(0)
        assert np.allclose(got, want, atol=1e-4)
    assert abs(sum(p("the", "cat", w) for w in uni) + p("the", "cat", "never") - 1) < 1e-9


def test_sample_has_4000_trusted_documents(spark):
    labels = spark.range(9000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    assert quality.trusted_sample(None, labels, "doc_id").count() == 4000


@pytest.mark.parametrize("head", [1 << 20, 40, 0])
def test_quality_fits_on_all_trusted_documents(spark, monkeypatch, head):
    """Also on more than 4,000 and on long ones, and with weights joined
    instead of broadcast; scores as by plain dictionaries."""
    monkeypatch.setattr(quality, "HEAD", head)
    rnd = random.Random(10)
    vocab = "the cat dog sat on a mat and ran home . , !".split()
    rows = [(i, " ".join(rnd.choice(vocab[: rnd.randrange(3, 13)]) for _ in range(rnd.randrange(9)))) for i in range(7000)]
    rows += [(7001 + i, "far " * 30_000 + "mat !") for i in range(4)]
    rows += [(8000, None), (8001, "zzz cat the unseen"), (8002, "far far"), (8002, "the"), (None, "a cat")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(5)
    labels = spark.createDataFrame([(i, 1) for i in range(7999)], "doc_id long, quality int")
    chosen = {r["id"] for r in quality.trusted(labels).where("fit").collect()}
    assert len(chosen) > 4500
    p, _ = plain_kneser_ney([t for i, t in rows if i in chosen])
    nats, n = {}, {}
    for t in {t or "" for _, t in rows}:
        own = [None, None, *quality.tokens(t.encode())]
        n[t], nats[t] = len(own) - 2, -sum(math.log(p(*own[i : i + 3])) for i in range(len(own) - 2))
    held = [t for i, t in rows if i is not None and i < 7999 and i not in chosen]
    mean = sum(nats[t] for t in held) / sum(n[t] for t in held)
    want = sorted((str(i), n[t or ""], math.exp((nats[t or ""] + quality.PRIOR * mean) / (n[t or ""] + quality.PRIOR))) for i, t in rows)
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["perplexity"]) for r in quality.classify(docs, labels).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-4)


def test_quality_in_slices_is_the_same_and_leaves_no_tables(spark, monkeypatch, tmp_path):
    """A slice's tables are gone before the next; they used to stay, all at
    once, until the session ended."""
    monkeypatch.setattr(quality, "HEAD", 8)
    rnd = random.Random(4)
    vocab = "the cat dog sat on a mat and ran home . , ! é".split()
    rows = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(20)))) for i in range(400)] + [(400, None), (5, "the cat"), (None, "a mat")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(300)], "doc_id long, quality int")
    paths = []
    monkeypatch.setattr("searchlake.llm.common.scratch_path", lambda _, name: paths.append(tmp_path / f"{len(paths)}-{name}") or str(paths[-1]))

    def found(per_slice):
        monkeypatch.setattr(quality, "PER_SLICE", per_slice)
        out = quality.classify(docs, labels)
        assert {p.name.split("-", 1)[1] for p in paths if p.exists()} == {"scores", "thresholds"}
        return sorted((str(r["doc_id"]), r["n_tokens"], r["perplexity"], r["threshold"]) for r in out.collect())

    one, several = found(1 << 30), found(1000)
    assert sum(p.name.endswith("-weights") for p in paths) > 4
    assert one == several


def test_hashes_tell_tokens_apart():
    rnd = random.Random(5)
    texts = [bytes(rnd.choices(b"ab9A \n\t\x0b.,\x00\xc3\xa9", k=rnd.randrange(60))) for _ in range(300)]
    texts += [b"x" * 300_000 + b" y", b"ab " * 100_000, b"", b"." * 140_000]
    h, n = quality.hashes(texts)
    want = [quality.tokens(t) for t in texts]
    assert n.tolist() == [len(x) for x in want]
    flat = [w for x in want for w in x]
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))


def test_quality_separates_and_keeps_good_documents(spark, tables):
    docs, labels = tables
    out = quality.classify(docs, labels)
    rows = [r.asDict() | {"bad": 1 - r["quality"]} for r in out.join(labels, "doc_id").collect()]
    assert auc(rows, "perplexity", "bad") > 0.93
    assert sum(r["rejected"] for r in rows if not r["bad"]) <= 0.02 * len(rows)
    assert sum(r["rejected"] for r in rows if r["bad"]) >= 0.3 * sum(r["bad"] for r in rows)
    assert out.count() == docs.count()


def test_quality_of_odd_tables(odd_docs, no_docs, odd_labels, no_labels):
    for labels in (odd_labels, no_labels):
        out = quality.classify(odd_docs, labels)
        assert out.count() == odd_docs.count()
        assert all(r["n_tokens"] == 0 or math.isfinite(r["perplexity"]) for r in out.collect())
    assert quality.keep_good(odd_docs, no_labels).count() == odd_docs.count()
    assert quality.keep_good(odd_docs, odd_labels).columns == odd_docs.columns
    assert quality.classify(no_docs, odd_labels).count() == 0


# --- toxicity ---------------------------------------------------------------------------


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.classify(docs, labels)
    rows = out.join(labels, "doc_id").where("held_out").collect()
    # Some 400 toxic documents to learn from; 0.999 with 2,000 of them.
    assert auc(rows, "score", "toxic") > 0.85
    clean = [r for r in rows if r["toxic"] == 0]
    assert sum(r["flagged"] for r in clean) <= 0.05 * len(clean)
    assert out.count() == docs.count() and out.where("score is null or score < 0 or score > 1").count() == 0


def test_network_finds_marked_texts_anywhere():
    rnd = random.Random(1)
    common = [f"w{i}" for i in range(400)]

    def text(bad):
        own = [rnd.choice(common) for _ in range(rnd.randrange(5, 120))]
        if bad:
            for w in rnd.sample(["vile", "vilest", "vileness", "foul", "foulest"], 2):
                own.insert(rnd.randrange(len(own) + 1), w)
        return [w.encode() for w in own]

    scorer = toxicity.fitted([text(True) for _ in range(300)], [text(False) for _ in range(600)], 300, 600)
    bad, good = scorer.scores([text(True) for _ in range(100)]), scorer.scores([text(False) for _ in range(100)])
    assert (bad >= 0.5).mean() > 0.9 and (good >= 0.5).mean() < 0.05
    one = scorer.scores([text(False) + [b"vile", b"foul"]])
    assert one[0] > good.mean()
    # A text's score does not depend on the texts beside it.
    many = [[], [b"a"], [b"vile", b"foul"], [], [b"w1", b"w2"], [b"foul"]]
    assert np.allclose(scorer.scores(many), [scorer.scores([x])[0] for x in many])


def test_toxicity_of_odd_tables(odd_docs, no_docs, odd_labels, no_labels):
    for labels in (odd_labels, no_labels):
        out = toxicity.classify(odd_docs, labels)
        assert out.count() == odd_docs.count()
        assert out.where("score is null").count() == 0
    assert toxicity.keep_clean(odd_docs, no_labels).columns == odd_docs.columns
    assert toxicity.keep_clean(odd_docs, no_labels).count() == odd_docs.count()
    assert toxicity.classify(no_docs, odd_labels).count() == 0


# --- fingerprints -----------------------------------------------------------------------


def test_fingerprints_of_edited_and_next_texts(spark, odd_docs, no_docs):
    docs = odd_docs.where("doc_id is null or doc_id <> 12 or text like '%first%'").dropDuplicates(["doc_id"])
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect() if r["doc_id"] is not None))
    out = {r["doc_id"]: r for r in fingerprint.with_edits(docs).collect()}
    assert len(out) == len(rows) + 1
    cache = WordHash()
    sig = {t: fingerprint.signatures([t.encode()], cache)[0] for _, t in rows}
    for (i, text), (_, follow) in zip(rows, rows[1:] + rows[:1]):
        new, r = fingerprint.edited(text, follow), out[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        own = fingerprint.signatures([new.encode()], cache)[0]
        assert r["fingerprint"] == fingerprint.hexes(sig[text][None])[0]
        assert r["near_edited"] == (own == sig[text]).mean()
        assert r["near_next"] == (sig[follow] == sig[text]).mean()
    alone = out[None]
    assert alone["edited_sha256"] == hashlib.sha256(b"no id at al").hexdigest() and alone["n_chars"] == 22
    assert fingerprint.with_edits(no_docs).count() == 0


def test_fingerprints_travel_as_bytes_and_share_common_shingles(spark, odd_docs):
    rnd = random.Random(4)
    texts = ["", "x", "! ?", *[" ".join(rnd.choice("abcdefgh") for _ in range(n)) for n in (1, 4, 5, 6, 40, 900)]]
    changed = [fingerprint.edited(a, b) for a, b in zip(texts, texts[1:] + texts[:1])]
    texts, changed = ([t.encode() for t in x] for x in (texts, changed))
    own, new = fingerprint.edited_signatures(texts, changed, WordHash())
    assert (own == fingerprint.signatures(texts, WordHash())).all() and (new == fingerprint.signatures(changed, WordHash())).all()
    rows = fingerprint._with_edits(odd_docs, "doc_id", "text").select("fingerprint", "edited_fingerprint", "edited_sha256").collect()
    assert {tuple(map(len, r)) for r in rows} == {(256, 256, 32)}


def test_edited_takes_code_points():
    assert fingerprint.edited("abcde", "XYZ") == "abcXY"
    assert fingerprint.edited("äöü\U0001F600", "日") == "äö日"
    assert fingerprint.edited("", "abc") == "" and fingerprint.edited("a", "b") == "a"


def test_many_documents_have_the_right_neighbours(spark):
    df = spark.range(3000).selectExpr("id * 7 as doc_id", "concat('text number ', id, ' a b c d ', id * 3) as text").repartition(9)
    out = {r["doc_id"]: r["edited_sha256"] for r in fingerprint.with_edits(df).collect()}
    text = [f"text number {i} a b c d {i * 3}" for i in range(3000)]
    want = {i * 7: hashlib.sha256(fingerprint.edited(text[i], text[(i + 1) % 3000]).encode()).hexdigest() for i in range(3000)}
    assert out == want


def test_similarity_estimate_and_near_pairs(spark):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    base = [rnd.choice(words) for _ in range(300)]
    near = list(base)
    near[10] = "changed"
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base)), (4, " ".join(rnd.sample(words, 300))), (5, ""), (6, None), (7, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    members, pairs = fingerprint.near_pairs(docs)
    assert {(r["doc_id"], r["class_id"]) for r in members.collect()} == {(1, 1), (2, 2), (3, 1), (4, 4), (5, 5), (6, 5), (7, 7)}
    assert [(r["a"], r["b"]) for r in pairs.collect()] == [(1, 2)]
    sig = fingerprint.signatures([t.encode() for _, t in rows[:2]], WordHash())
    assert abs((sig[0] == sig[1]).mean() - 291 / 301) < 0.15


def test_op5_links_rows_of_repeated_ids_and_large_groups(spark, monkeypatch):
    """Links by the text's digest, a few a member in a group of near copies."""
    from searchlake.llm import queries

    rnd = random.Random(8)
    words = [f"w{i}" for i in range(5000)]
    base, other = ([rnd.choice(words) for _ in range(300)] for _ in range(2))

    def edit(x, k):
        return " ".join([*x[:k], f"e{k}", *x[k + 1 :]])

    rows = [(i, edit(base, i)) for i in range(200)]
    # The same id stands for a copy of one group and a text of the other.
    rows += [(5, " ".join(other)), (300, edit(other, 7)), (None, edit(other, 9)), (301, edit(other, 7)), (302, ""), (None, None), (303, " ".join(words[:50]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    monkeypatch.setattr(queries, "read_table", lambda *_: docs)
    out = queries.op5_minhash(spark, "").collect()
    plain = fingerprint.with_edits(docs)
    assert sorted(map(str, ((r["doc_id"], r["n_chars"], r["near_next"]) for r in out))) == sorted(map(str, ((r["doc_id"], r["n_chars"], r["near_next"]) for r in plain.collect())))
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_chars"], r["class_id"], r["n_links"] > 0) for r in out)
    first = {}
    for i, t in rows:
        first[t or ""] = min([x for x in (i, first.get(t or "")) if x is not None], default=None)
    want = sorted((i if i is not None else -1, len(t or ""), first[t or ""], t not in ("", None, " ".join(words[:50]))) for i, t in rows)
    assert list(map(str, got)) == list(map(str, want))
    classes, found = fingerprint.links(docs)
    assert classes.count() == len(first)
    near = found.collect()
    # Each member with the first of its buckets, not the 19,903 pairs.
    assert 199 + 2 <= len(near) <= 10 * 203 and all(r["jaccard"] >= 0.75 for r in near)


# --- masked language model ---------------------------------------------------------------


def test_probabilities_are_normalised_and_training_helps():
    rnd = random.Random(3)
    texts = [[f"s{(i + k) % 9}".encode() for k in range(40)] for i in range(200)]
    vocab = [f"s{i}".encode() for i in range(9)]
    known = lm_score.Words(vocab)
    token, window, _ = lm_score.windows(texts, known)
    net, past = lm_score.Network(), lm_score.Network()
    past.flat[:] = 1e-6
    before = net.log_probability(token, window).mean()
    for _ in range(30):
        net.train(token, window, past)
    after = net.log_probability(token, window).mean()
    assert after > before + 3
    every = np.arange(lm_score.VOCABULARY)
    assert abs(np.exp(net.log_probability(every, np.repeat(window[:, :1], len(every), axis=1))).sum() - 1) < 1e-4
    mixed, window, _ = lm_score.windows([rnd.sample(t, len(t)) for t in texts], known)
    assert net.log_probability(mixed, window).mean() < after - 1


def test_scores_add_up_and_windows_stay_inside_texts(odd_docs, no_docs):
    out = {(r["doc_id"], r["n_words"]): r for r in lm_score.score(odd_docs).collect()}
    words, weights = lm_score.fit(odd_docs.selectExpr("coalesce(text, '') as text"))
    net = lm_score.Network()
    net.flat[:] = weights
    for r in odd_docs.collect():
        own = lm_score.item_words((r["text"] or "").encode())
        got = out[r["doc_id"], len(own)]
        token, window, _ = lm_score.windows([own], lm_score.Words(words))
        want = float(net.log_probability(token, window).sum()) if own else 0.0
        assert abs(got["pll"] - want) < 1e-2 + 1e-3 * abs(want) or r["doc_id"] == 12
        assert (got["mean_pll"] is None) == (not own)
    assert lm_score.score(no_docs).count() == 0
    assert re.fullmatch(r"\w+", words[0].decode())


def plain_bucket_costs(texts):
    """-ln p(word | bucket) of every word outside the network, from dictionaries."""
    from collections import Counter

    n = Counter(w for t in texts for w in lm_score.item_words(t.encode()))
    for w in sorted(n, key=lambda w: (-n[w], w))[: lm_score.WORDS]:
        del n[w]
    total = Counter()
    for w, c in n.items():
        total[lm_score.word_hash(w) % lm_score.OTHERS] += c + lm_score.SMOOTH
    return {w: math.log((total[lm_score.word_hash(w) % lm_score.OTHERS] + lm_score.SMOOTH) / (c + lm_score.SMOOTH)) for w, c in n.items()}


@pytest.mark.parametrize("head", [1 << 20, 1300, 960])
def test_rare_words_have_their_own_probability(spark, monkeypatch, head):
    """Also when their counts are joined instead of broadcast."""
    monkeypatch.setattr(lm_score, "HEAD", head)
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(4000)]
    texts = [" ".join(vocab[int(4000 * rnd.random() ** 4)] for _ in range(rnd.randrange(40))) for _ in range(1200)]
    # The network's words get counts that keep them in any head.
    texts += [" ".join(f"f{i}" for i in range(800))] * 150
    costs = plain_bucket_costs(texts)
    bucket = {}
    for w in sorted(costs):
        bucket.setdefault(lm_score.word_hash(w) % lm_score.OTHERS, []).append(w)
    # Two texts that differ in one rare word of the same bucket.
    a, b = next((sorted(x, key=costs.get)[len(x) // 2], max(x, key=costs.get)) for x in bucket.values() if len({costs[w] for w in x}) > 4)
    texts += [f"f1 f2 {a.decode()} f3", f"f1 f2 {b.decode()} f3"]
    costs = plain_bucket_costs(texts)
    docs = spark.createDataFrame([(i // 2 if i % 7 else None, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    words, least = lm_score.vocabulary(lm_score.word_counts(docs))
    assert len(words.keys) <= head and (least > 0) == (head < 1 << 20)
    got = sorted((r["doc_id"] or -1, r["n_words"], round(r["pll"], 1)) for r in lm_score.score(docs).collect())
    net = lm_score.Network()
    net.flat[:] = lm_score.trained(docs.selectExpr("coalesce(text, '') as text"), words)
    plain, pll = lm_score.Words(list(words)), {}
    for t in set(texts):
        own = lm_score.item_words(t.encode())
        token, window, _ = lm_score.windows([own], plain)
        pll[t] = (float(net.log_probability(token, window).sum()) if own else 0.0) - sum(costs.get(w, 0.0) for w in own)
    want = sorted((r["doc_id"] or -1, len(lm_score.item_words(r["text"].encode())), pll[r["text"]]) for r in docs.collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose(sorted(g[2] for g in got), sorted(w[2] for w in want), atol=0.2, rtol=1e-3)
    assert abs(pll[texts[-2]] - pll[texts[-1]] - costs[b] + costs[a]) < 1e-3 and costs[b] > costs[a]


def test_bucket_probabilities_are_normalised(spark):
    rnd = random.Random(6)
    texts = [" ".join(f"w{rnd.randrange(3000)}" for _ in range(30)) for _ in range(300)]
    words, _ = lm_score.vocabulary(lm_score.word_counts(spark.createDataFrame([(t,) for t in texts], "text string")))
    known, mass = lm_score.Words(words), np.zeros(lm_score.OTHERS)
    for w in {w for t in texts for w in lm_score.item_words(t.encode())} - set(words):
        n = known[w]
        assert not n & lm_score.JOINED
        mass[(n & lm_score.PLACE) - lm_score.WORDS] += math.exp(-(n >> lm_score.COST) / lm_score.UNITS)
    assert np.allclose(mass + lm_score.SMOOTH / words.sums, 1, atol=1e-4)
    assert known[b"never-seen"] & lm_score.JOINED


def test_op5_counts_every_link_between_different_texts(spark, monkeypatch):
    """Each text's links as by brute force, also where a component has many blocks."""
    rnd = random.Random(21)
    words = [f"w{i}" for i in range(900)]
    rows = []
    for g in range(6):
        text = [rnd.choice(words) for _ in range(80)]
        for _ in range(2 + 5 * g):
            # A walk: texts near in order are linked, those far apart are not.
            text[rnd.randrange(80)] = rnd.choice(words)
            rows.append((len(rows), " ".join(text)))
    rows += [(900, rows[3][1]), (None, rows[9][1]), (901, " "), (902, None)]
    sets = {t: set(fingerprint.sets_of([t.encode()], WordHash())[0].tolist()) for _, t in rows if t}
    want = {t: sum(100 * len(s & o) >= 75 * len(s | o) for u, o in sets.items() if u != t) for t, s in sets.items()}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for size in (256, 4):
        monkeypatch.setattr(fingerprint, "BLOCK_CLASSES", size)
        out = fingerprint.with_links(docs).collect()
        got = sorted((str(r["doc_id"]), r["n_links"]) for r in out)
        assert got == sorted((str(i), want.get(t, 0)) for i, t in rows)


def test_links_leave_one_table(spark, monkeypatch, tmp_path):
    """The tables behind the links are gone when the last step begins; all of
    them used to stay beside its shuffle."""
    docs = spark.createDataFrame([(i, f"one two three four five six {i // 2} " * 9) for i in range(20)], "doc_id long, text string")
    paths = []
    monkeypatch.setattr("searchlake.llm.common.scratch_path", lambda _, name: paths.append(tmp_path / f"{len(paths)}-{name}") or str(paths[-1]))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    out = fingerprint.with_links(docs)
    assert len(paths) > 5 and [p.name.split("-", 1)[1] for p in paths if p.exists()] == ["labels"]
    assert spark.conf.get(key, None) == before
    assert sorted((r["doc_id"], r["class_id"]) for r in out.collect()) == [(i, i - i % 2) for i in range(20)]
