"""The operators with Python parts against brute force, libraries, round trips and held-out accuracy."""

import io
import math
import random
import re
from collections import Counter, defaultdict
from hashlib import sha1, sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltmark.llm import near_dedup, pii, quality_classifier, secret_scan, token_rollup, warc
from siltmark.llm._common import new_folder
from siltmark.llm.bpe import WordBPE, encode_documents, tokenizer_path
from siltmark.operators.store import publish


def count(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


# --- near duplicates ---


def brute_components(rows, width, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(low))
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            same = len(a & sets[j])
            if a and sets[j] and 100 * same >= percent * (len(a) + len(sets[j]) - same) or rows[i][0] is not None and rows[i][0] == rows[j][0]:
                up[top(i)] = top(j)
    least = defaultdict(lambda: None)
    for i, r in enumerate(rows):
        if r[0] is not None:
            t = top(i)
            least[t] = r[0] if least[t] is None else min(least[t], r[0])
    return Counter((r[0], len(sets[i]), least[top(i)], least[top(i)] is None if r[0] is None else r[0] == least[top(i)]) for i, r in enumerate(rows))


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, docs, rows, width, percent):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    chain = []
    for i in range(40):  # each a step from one before, so that ends aren't linked directly
        words = chain[rng.randrange(len(chain))][1].split() if chain else list(base)
        words[rng.randrange(80)] = f"x{i}"
        chain.append((600 + i, " ".join(words)))
    chain += [(800, "the first text of a repeated identifier"), (800, "and its other text is this one"), (790, "and its other text is this one")]
    df = docs.select("doc_id", "text", "rep").unionByName(spark.createDataFrame(chain, "doc_id long, text string"), allowMissingColumns=True)
    found = near_dedup.near_duplicates(df, width=width, percent=percent)
    assert count(found, "doc_id", "n_shingles", "component_id", "kept") == brute_components([*rows, *chain], width, percent)


def test_near_duplicates_of_nothing(empty, spark):
    assert near_dedup.near_duplicates(empty).count() == 0
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert count(near_dedup.near_duplicates(only), "component_id", "kept") == Counter({(1, True): 1, (2, True): 1})


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60, 1) if i % 20 != 19] + [(200, 200 + i) for i in range(1, 50)] + [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(30)]
    up = {}
    for u, v in edges:
        up.setdefault(u, u), up.setdefault(v, v)
    for _ in range(100):
        for u, v in edges:
            up[u] = up[v] = min(up[u], up[v])
    alone = {u for u in up if all(u not in e or e[0] == e[1] for e in edges)}
    got = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {u: c for u, c in up.items() if u not in alone}


# --- secrets ---

BASE = [(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 8), (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), (r"[0-9a-f]+", lambda m: len(m[0]) >= 32)]
KINDS = ["assign", "access", "hex"]


def brute_secrets(text):
    found = [(m.start(), i, m.end()) for i, (p, ok) in enumerate(BASE) for m in re.finditer(p, text) if ok(m)]
    return [(KINDS[i], a, b) for a, i, b in sorted(found)]


def test_secret_spans(spark, docs, rows):
    rng = random.Random(5)
    bits = ["password", "passwd", "TOKEN", "api_key", "apikey", "Secret", '"', "'", " ", "=", ":", "AKIA", "ABCDEFGH12345678", "deadbeef0123", "xyz", "-", "é", "\n", "a", "0", "ghp_" + "a1" * 12]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(400)] + ["token='" + "a" * 100_000, "-----BEGIN RSA PRIVATE KEY-----"]
    df = docs.select("doc_id", "text", "key").unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"), allowMissingColumns=True)
    found = secret_scan.scan_secrets(df).collect()
    want = Counter((i, tuple(brute_secrets(t or ""))) for i, t in [(r[0], r[1]) for r in rows] + [(1000 + i, t) for i, t in enumerate(texts)])
    assert Counter((r.doc_id, tuple(tuple(s) for s in r.found if s.kind in KINDS)) for r in found) == want
    assert [s.kind for r in found if r.doc_id == 1000 + len(texts) - 1 for s in r.found] == ["private_key"]


def test_no_secrets_in_nothing(empty):
    assert secret_scan.scan_secrets(empty).count() == 0


def test_minimal_automaton():
    # (a|b)*abb, the textbook's four states
    machine = secret_scan.compiled([secret_scan.parse("(a|b)*abb")], anywhere=False)
    assert machine.size == 5  # and one for other bytes


# --- classifier ---


def test_classifier_held_out(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    data, labels = [], []
    for i in range(600):
        good = i % 3 > 0
        words = [word() for _ in range(rng.randint(20, 60))]
        data.append((i, " ".join(words if good else [w + rng.choice(["###", "|", "!!"]) for w in words]), "a"))
        labels.append((i, int(good), 9))
    data += [(None, None, "a"), (7, data[7][1], "a"), (9000, "", "b")]
    docs = spark.createDataFrame(data, "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (None, 1, 0), (5, None, 0)], "doc_id long, quality int, text int")
    found = quality_classifier.score_documents(docs, marks).collect()
    assert len(found) == len(data) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    truth = {i: g for i, g, _ in labels}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert all(r.held_out == quality_classifier.crc_fold(r.doc_id) for r in found if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held) > 50
    good = quality_classifier.good_documents(docs, marks)
    assert good.columns == docs.columns and good.count() == sum(r.predicted for r in found)


@pytest.mark.parametrize("seed", [1, 2])
def test_classifier_equals_a_plain_fit(seed):
    """Bradley-Terry strengths that are linear in the features, by Newton's method on the same preferences."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(300, len(quality_classifier.FEATURES)))
    good = x[:, 0] + 0.5 * x[:, 3] ** 2 + rng.normal(size=300) > 0.4
    model = quality_classifier.fit(x, good, pairs=3000, penalty=1e-3, steps=4000)
    z = quality_classifier.expanded((x - x.mean(0)) / (x.std(0) + 1e-6))
    a, b = quality_classifier.preferences(np.flatnonzero(good), np.flatnonzero(~good), 3000, 3)
    d, w = z[a] - z[b], np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(d @ w))
        slope = -(d * p[:, None]).mean(0) + 1e-3 * w
        w -= np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / len(d) + 1e-3 * np.eye(len(w)), slope)
    assert np.abs(model.weights - w).max() < 0.02 and np.corrcoef(model.raw(x), z @ w)[0, 1] > 0.9999
    # the cut: no quantile of these scores keeps fewer bad and loses fewer good ones
    raw = z @ model.weights
    lost = lambda c: ((raw < c) & good).mean() + ((raw >= c) & ~good).mean()
    assert lost(model.cut) <= min(map(lost, raw)) + 1e-12


def test_classifier_on_odd_rows(spark, docs, rows):
    """Nulls, long and empty texts score between 0 and 1, the same for equal texts; repeated identifiers count once in the fit."""
    marks = spark.createDataFrame([(i, int(i < 100)) for i, *_ in rows if i is not None and (i < 12 or 200 <= i < 300)], "doc_id long, quality int")
    found = quality_classifier.score_documents(docs, marks).collect()
    texts = defaultdict(set)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and (r.doc_id is not None or r.held_out)
        texts[r.doc_id].add(r.score)
    assert len(found) == len(rows) and texts[400] == texts[401] == texts[402] and len(texts[407]) == 1
    again = docs.unionByName(docs.filter("doc_id < 12").select(*docs.columns))
    same = {r.doc_id: r.score for r in quality_classifier.score_documents(again, marks).collect()}
    assert all(abs(same[i] - next(iter(s))) < 1e-9 for i, s in texts.items() if i is not None and len(s) == 1)


def test_classifier_without_labels(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_classifier.score_documents(docs, none).filter("predicted = 0").isEmpty()
    assert quality_classifier.score_documents(empty, none).count() == 0


# --- BPE ---


def test_bpe_equals_library(spark, docs, rows):
    from tokenizers import Tokenizer

    own, model = Tokenizer.from_file(tokenizer_path()), WordBPE(open(tokenizer_path()).read())
    texts = ["", "It's we'll DON'T <|endoftext|>abc<|startoftext|> x", "ΑΣΣ ΟΔΟΣ İstanbul ǅ", "a\x1cb\x1d c d\x85e", "é ̈x ﬁ ½ 12 345 日本語 😀👍🏽", "lo" * 777 + "!?!?" * 30, "<|endoftext|><|endoftext|>", "< |endoftext|"]
    for t in [*texts, *[r[1] or "" for r in rows]]:
        ids = own.encode(t, add_special_tokens=False).ids
        assert model.encode(t) == ids
        assert model.decode(ids) == own.decode(ids, skip_special_tokens=False)
    found = encode_documents(docs, tokenizer_path(), full=True).collect()
    want = Counter()
    for i, t, *_ in rows:
        ids = own.encode(t or "", add_special_tokens=False).ids
        text = own.decode(ids, skip_special_tokens=False)
        want[(i, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(text.encode()).hexdigest(), tuple(ids), text)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids), r.decoded) for r in found) == want


def test_bpe_of_nothing(empty):
    assert encode_documents(empty, tokenizer_path()).count() == 0


# --- PII ---

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))), ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(pii.digits_of(s)) <= 19 and pii.luhn(pii.digits_of(s))), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(pii.digits_of(s)) <= 15)]


def test_pii_base_spans():
    rng = random.Random(2)
    bits = ["@", "a.b", "foo", ".", "com", "-", "1", "23", "456", " ", "+1 (555) 123", "4111111111111111", "192.168.0.1", "é", "%", "+", "(", ")", "999", "0", "12345678"]
    for _ in range(5000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 16)))
        want = sorted([(m.start(), m.end(), k) for k, p, ok in PATTERNS for m in re.finditer(p, t) if ok(m[0])], key=lambda s: (s[0], pii.KINDS.index(s[2])))
        assert pii.base_spans(t) == want
    assert len(pii.base_spans("1" * 50_000 + "a" * 50_000 + "@")) == 0  # in linear time


def told_by_brute_force(texts, window, z, generalise, remove):
    """Each term's disclosure, from the definition."""
    n, n_t, n_f, n_tf, shown = len(texts), Counter(), Counter(), Counter(), defaultdict(set)
    for text in texts:
        text = text or ""
        n_t.update({w.lower() for w in re.findall(r"[^\W_]+(?:[-'][^\W_]+)*", text)})
        spans = pii.base_spans(text)
        terms = [(m.start(), m[0].lower()) for m in re.finditer(r"[^\W_]+(?:[-'][^\W_]+)*", text) if not any(a < m.end() and m.start() < b for a, b, _ in spans)]
        facts_, near = set(), set()
        for a, b, k in spans:
            around = [x for at, x in terms if at < a][-window:] + [x for at, x in terms if at >= b][:window]
            facts_ |= set(pii.facts(k, text[a:b]))
            near |= {(f, x) for f in pii.facts(k, text[a:b]) for x in around}
        n_f.update(facts_)
        n_tf.update(near)
        for pair in near:
            shown[pair].add(text)
    best = {}
    for (f, t), k in n_tf.items():
        if n_f[f] < n:
            m = len(shown[f, t])
            share = math.log(k / n_t[t] * m / (m + z * z) * n / n_f[f]) / math.log(n / n_f[f])
            best[t] = max(best.get(t, -9.0), share)
    return {t: (round(s, 9), "remove" if s >= remove else "generalise") for t, s in best.items() if s >= generalise}


def pii_texts(seed):
    """Texts of few words with few entities, so that all shares occur; copies and near copies among them."""
    rng = random.Random(seed)
    entities = ["bob@corp.example.com", "Bob.2@corp.example.com", "ann@other.example.org", "10.1.2.3", "10.1.9.3", "+1 (555) 123-4567", "+1 (555) 765-4321", "4111111111111111"]
    word = lambda: rng.choice("the a of in Kestrel d'or time ÉTÉ x-ray".split() + [f"w{rng.randint(0, 60)}"])
    texts = [" ".join(rng.choice(entities) if rng.random() < 0.06 else word() for _ in range(rng.randint(0, 30))) for _ in range(150)]
    return [*texts, *texts[:20], *[t + " more" for t in texts[20:30]], None, "", "\u0130\u03a3 10.1.2.3 \u039f\u0394\u039f\u03a3.\u0391"]


@pytest.mark.parametrize("seed", [1, 2])
def test_pii_disclosures_equal_brute_force(spark, seed):
    texts = pii_texts(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(5)
    for window, z, generalise, remove in ((4, 1.0, 0.85, 0.95), (2, 0.5, 0.3, 0.8), (3, 0.0, 0.0, 0.9)):
        want = told_by_brute_force(texts, window, z, generalise, remove)
        found = {r.term: (round(r.disclosure, 9), r.action) for r in pii.disclosures(docs, window=window, z=z, generalise=generalise, remove=remove).collect()}
        assert found == want and (generalise > 0.8 or {a for _, a in found.values()} == {"generalise", "remove"})
        spans = {r.doc_id: [(s.start, s.stop, s.kind) for s in r.spans] for r in pii.find_pii(docs, window=window, z=z, generalise=generalise, remove=remove).collect()}
        for i, t in enumerate(texts):
            base = pii.base_spans(t or "")
            marked = [(m.start(), m.end(), want[m[0].lower()][1]) for m in re.finditer(r"[^\W_]+(?:[-'][^\W_]+)*", t or "") if base and m[0].lower() in want and not any(a < m.end() and m.start() < b for a, b, _ in base)]
            assert spans[i] == sorted(base + marked, key=lambda s: s[0])


def test_pii_counts_are_handed_on_in_parts(spark):
    docs = spark.createDataFrame([(i, f"a b{i % 7} c{i}") for i in range(40)], "doc_id long, text string").repartition(2)
    assert {tuple(r) for r in pii.document_counts(docs, "text", held=5).collect()} == {tuple(r) for r in pii.document_counts(docs, "text").collect()}


def test_pii_telling_terms(spark):
    texts = [f"filler{i} some words the Zanzibar quux call +1 (555) 123-45{10 + i} or mail bob@corp.example.com the day{i}" for i in range(6)]
    texts += [f"plain text number {i} where the words are common some call or mail" for i in range(60)] + ["only Zanzibar here", None, ""]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    told = {r.term: r.action for r in pii.disclosures(docs).collect()}
    assert told == {"quux": "generalise", "zanzibar": "generalise"}
    found = {r.doc_id: r for r in pii.find_pii(docs, with_text=True).collect()}
    assert [s.kind for s in found[0].spans] == ["generalise", "generalise", "phone", "email"]
    assert all(not r.spans for i, r in found.items() if i >= 6)  # what holds no entity stays as it is
    assert found[0].sanitised == "filler0 some words the [NAME] [TERM] call [PHONE] or mail [EMAIL] the day0"
    assert found[66].sanitised == texts[66] and found[67].sanitised is None and found[68].sanitised == ""


def test_pii_terms_are_flagged(spark):
    texts = [f"a{i} b{i} agent Kestrel mails spy@secret.example.org c{i} d{i}" for i in range(5)] + [f"agent mails text {i}" for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    told = {r.term: r.action for r in pii.disclosures(docs).collect()}
    assert told == {"kestrel": "remove"}
    copies = spark.createDataFrame([(i, texts[0]) for i in range(50)], "doc_id long, text string")
    assert pii.disclosures(copies).isEmpty()


def test_pii_terms_of_a_shared_line(spark):
    texts = [f"letter {i} about matter{i}\nbest regards from Jane Kestrel, jane@corp.example.com" for i in range(5)] + [f"letter {i} best regards from nobody" for i in range(200)]
    told = {r.term: r.action for r in pii.disclosures(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert told == {"jane": "remove", "kestrel": "remove"}


def test_pii_counts_documents(spark):
    # the two together in 3 documents with 20 windows each; the share is log(3/6 * 3/4 * 1000/5) / log(1000/5)
    texts = [" ".join(f"p{i}x{j} a b Kestrel spy@secret.example.org c d q{i}x{j}" for j in range(20)) for i in range(3)]
    texts += [f"r{i} spy@secret.example.org" for i in range(2)] + [f"kestrel flies {i}" for i in range(3)] + [f"a b c d {i}" for i in range(992)]
    found = pii.disclosures(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), generalise=0.5).collect()
    assert {r.term: round(r.disclosure, 4) for r in found if r.term.isalpha()} == {"kestrel": 0.8149}
    copies = [(i, "a b Kestrel spy@secret.example.org") for i in range(50)] + [(50 + i, f"a b {i}") for i in range(150)]
    found = pii.disclosures(spark.createDataFrame(copies, "doc_id long, text string"), generalise=0.0).collect()
    assert {r.term: round(r.disclosure, 4) for r in found} == {"kestrel": 0.5}  # 50 copies are one text


def test_pii_window_is_of_terms():
    mails = " ".join(f"some.body{i}@mail{i}.corp.example.com" for i in range(20))
    text = f"zero one two three four {mails} spy@x.example.org {'.' * 5000} five {'-' * 300} six {'w' * 700} eight nine"
    near = {t for f, t in pii.seen_near(text, 4)[2] if f == pii.facts("email", "spy@x.example.org")[0]}
    assert near == {"one", "two", "three", "four", "five", "six", "w" * 700, "eight"}
    rng = random.Random(6)
    bits = ["a@b.cd", "éa@b.cd", "foo", "bar-baz", "+1 (555) 123-4567", "4111111111111111", "192.168.0.1", "1.2.3.4x", "it's", "_", ".", "-"]
    for _ in range(500):
        t = " ".join(rng.choice(bits) + rng.choice(["", str(rng.randint(0, 9))]) for _ in range(rng.randint(0, 30)))
        spans = pii.base_spans(t)
        terms = [(m.start(), m[0].lower()) for m in re.finditer(r"[^\W_]+(?:[-'][^\W_]+)*", t) if not any(a < m.end() and m.start() < b for a, b, _ in spans)]
        want = {(f, x) for a, b, k in spans for x in [x for at, x in terms if at < a][-4:] + [x for at, x in terms if at >= b][:4] for f in pii.facts(k, t[a:b])}
        assert pii.seen_near(t, 4)[2] == want


def test_pii_edges(docs, empty):
    assert pii.find_pii(docs).count() == docs.count()
    assert pii.find_pii(empty, with_text=True).count() == 0


# --- WARC ---


def pages(spark):
    html = ["<p>é</p>", "", None, "<p>é</p>", "x" * 300_000, "<p>é</p>", ""]
    rows = [(i, f"http://e/{i}\r\nX: y", h, 1) for i, h in enumerate(html)] + [(None, None, "<p>é</p>", 2), (None, None, "alone", 3), (5, "u", "<p>é</p>", 4)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string, archive int")


@pytest.mark.parametrize("least", [0, 5])
def test_warc_round_trip(spark, least):
    rows, df = pages(spark)
    folder = new_folder(spark, "warc-test")
    archives = warc.write_archives(df, folder, least_bytes=least)
    assert archives.agg(F.sum("records")).first()[0] == len(rows)
    found = warc.read_archives(archives, folder, with_payload=True).collect()
    top = {}
    for i, _, h, _ in rows:
        if i is not None:
            top[h or ""] = max(i, top.get(h or "", -1))
    want = Counter()
    for i, u, h, _ in rows:
        data, to = (h or "").encode(), top.get(h or "")
        own = len(data) < least or to is None or i == to
        want[(i, None if u is None else u.replace("\r", "%0D").replace("\n", "%0A"), len(data), warc.digest_name(sha1(data).digest()), "response" if own else "revisit", None if own else to, True, data if own else b"")] += 1
    assert Counter((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.valid, bytes(r.payload)) for r in found) == want
    whole = warc.read_warc(spark, folder)
    assert count(whole, "page_id", "payload_digest") == Counter((k[0], k[3]) for k in want.elements())


def test_warc_damage():
    good = [warc.record(i, "u", b"payload %d" % i) for i in range(3)]
    assert [r["valid"] for r in warc.records(io.BytesIO(b"".join(good)))] == [True] * 3
    import gzip

    bad = gzip.compress(gzip.decompress(good[1]).replace(b"payload 1", b"pAyload 1"))
    assert [r["valid"] for r in warc.records(io.BytesIO(good[0] + bad + good[2]))] == [True, False, True]
    cut = list(warc.records(io.BytesIO(good[0] + good[1][:-20])))
    assert cut[0]["valid"] and not cut[1]["valid"] and cut[1]["error"]
    assert gzip.decompress(good[0]).startswith(b"WARC/1.1\r\n")


def test_warc_reads_on_after_a_damaged_member():
    import gzip

    noise = random.Random(8).randbytes(300_000)
    first, last, plain = warc.record(0, "u", b"a"), warc.record(2, "u", b"b"), gzip.decompress(warc.record(1, "u", noise))
    size = re.search(rb"\r\nContent-Length: (\d+)\r\n\r\nHTTP", plain)[1]
    length = lambda n: plain.replace(b"\r\nContent-Length: " + size + b"\r\n\r\nHTTP", n + b"\r\n\r\nHTTP")
    bad = [plain.replace(b"URI: u", b"URI: \xe9"), length(b""), length(b"\r\nContent-Length: x"), length(b"\r\nContent-Length: 9"), length(b"\r\nContent-Length: 9999999"), length(b"\r\nContent-Length: -7"), b"WARC/1.1\r\n" + b"x" * 3_000_000, b"no record " + noise]
    for data in bad:
        found = list(warc.records(io.BytesIO(first + gzip.compress(data) + last)))
        assert [r["valid"] for r in found] == [True, False, True] and [found[i]["fields"]["x-row"] for i in (0, 2)] == ["0", "2"]
    cut = list(warc.records(io.BytesIO(first + gzip.compress(bad[0])[:-20])))
    assert [r["valid"] for r in cut] == [True, False] and cut[1]["error"]


def test_warc_of_long_uris(spark):
    uri = "http://e/" + "x" * 3_000_000
    df = spark.createDataFrame([(1, uri, "a"), (2, "u", "b"), (3, "v", "c")], "page_id long, url string, html string").coalesce(1)
    folder = new_folder(spark, "warc-test")
    found = warc.read_archives(warc.write_archives(df, folder), folder)
    assert count(found, "page_id", "url", "valid") == Counter({(1, uri, True): 1, (2, "u", True): 1, (3, "v", True): 1})


def test_warc_of_nothing(spark):
    folder = new_folder(spark, "warc-test")
    archives = warc.write_archives(pages(spark)[1].limit(0), folder)
    assert archives.count() == 0 and warc.read_archives(archives, folder).count() == 0


# --- rollup ---


def test_rollup_is_idempotent(spark):
    rollup = token_rollup.TokenRollup(spark, new_folder(spark, "rollup-test"))
    assert rollup.totals().count() == 0
    cols = "op string, source string, lang string, tokenizer string, n_tokens long, old_tokenizer string, old_tokens long, n_docs int"
    batch = lambda *rows: spark.createDataFrame([(*r, 7) for r in rows], cols)
    first = batch(("insert", "a", "en", "v1", 10, None, None), ("insert", "a", "en", "v1", 5, None, None), ("insert", None, None, "v1", 3, None, None), ("insert", "b", "en", "v1", None, None, None), ("what", "a", "en", "v1", 99, None, None))
    assert rollup.commit("one", first) and not rollup.commit("one", first)
    second = batch(("delete", "a", "en", None, None, "v1", 5), ("revise", "a", "en", "v2", 12, "v1", 10), ("delete", None, None, None, None, "v1", 3))
    assert rollup.commit("two", second) and not rollup.commit("two", second)
    assert rollup.commit("none", batch().limit(0))
    assert count(rollup.totals(), "source", "lang", "tokenizer", "n_docs", "n_tokens") == Counter({("a", "en", "v2", 1, 12): 1, ("b", "en", "v1", 1, 0): 1})
    again = token_rollup.TokenRollup(spark, rollup.folder)
    assert again.totals().count() == 2 and not again._publish("two", "x")


def test_rollup_survives_crashes(spark, monkeypatch):
    cols = "op string, source string, lang string, tokenizer string, n_tokens long, old_tokenizer string, old_tokens long"
    rows = spark.createDataFrame([("insert", "a", "en", "v1", 7, None, None)], cols)
    rollup = token_rollup.TokenRollup(spark, new_folder(spark, "rollup-test"))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # after the data, before the commit
        m.setattr(token_rollup, "publish", dies)
        with pytest.raises(RuntimeError):
            rollup.commit("one", rows)
    assert rollup.totals().count() == 0
    real = spark._jvm.org.apache.hadoop.fs
    half = f"{rollup.folder}/commits/.one.half"  # the commit was being written
    rollup._fs.create(real.Path(half), False).close()
    assert rollup.batches() == {} and rollup.commit("one", rows) and not rollup.commit("one", rows)
    assert count(rollup.totals(), "source", "n_docs", "n_tokens") == Counter({("a", 1, 7): 1})
    with monkeypatch.context() as m:  # after the commit
        m.setattr(token_rollup, "publish", lambda *x: publish(*x) and dies())
        with pytest.raises(RuntimeError):
            rollup.commit("two", rows)
    assert not rollup.commit("two", rows)
    assert count(rollup.totals(), "source", "n_docs", "n_tokens") == Counter({("a", 2, 14): 1})
    # of two writers of one batch that both got past the first look, one counts
    assert not publish(spark, f"{rollup.folder}/commits/two", "other") and rollup.totals().first().n_tokens == 14


def test_warc_headers(spark, monkeypatch):
    import gzip

    monkeypatch.setattr(warc, "HEADER", 1 << 20)
    good = [warc.record(i, "u", b"x%d" % i) for i in range(2)]
    long = gzip.compress(b"WARC/1.1\r\nWARC-Target-URI: " + b"u" * 5_000_000 + b"\r\n\r\n")
    found = list(warc.records(io.BytesIO(good[0] + long + good[1])))
    assert [r["valid"] for r in found] == [True, False, True] and "more than" in found[1]["error"]
    block = b"HTTP/1.1 200 OK\r\n" + b"X: y\r\n" * 200_000  # whose HTTP header never ends: there is no payload
    text = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % len(block)
    odd = list(warc.records(io.BytesIO(gzip.compress(text + block + b"\r\n\r\n") + good[1])))
    assert [(r["valid"], r["payload_bytes"]) for r in odd] == [(True, 0), (True, 2)]
    for n in range(8, 70):  # the header's end may fall between any two pieces
        monkeypatch.setattr(warc, "PIECE", n)
        assert [(r["valid"], r["payload_bytes"]) for r in warc.records(io.BytesIO(b"".join(good)))] == [(True, 2)] * 2


def test_warc_settings_stay(spark):
    folder = new_folder(spark, "warc-test")
    warc.write_archives(pages(spark)[1], folder)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    assert warc.read_warc(spark, folder).count() == 10 and spark.conf.get(key) == before
