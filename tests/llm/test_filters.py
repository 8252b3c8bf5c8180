import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from strandline.llm import decontaminate, language, quality, secrets

SCANNER = secrets.Scanner(secrets.ranked_words())
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_hits(text, items):
    words = WORD.findall(low(text))
    hit, own = set(), set()
    for item, body in items:
        w = WORD.findall(low(body))
        for win in {tuple(w[i : i + 8]) for i in range(max(1, len(w) - 7))} if w else ():
            for i in range(len(words) - len(win) + 1):
                if tuple(words[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    own.add(item)
    return len(words), len(hit), own


def test_decontamination_equals_brute_force(spark, sf, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = decontaminate.query(spark, sf).collect()
    assert len(got) == len(texts)
    rng = random.Random(2)
    for r in [r for r in got if r.n_items] + rng.sample(got, 25):
        n, hit, own = brute_hits(texts[r.doc_id][:20000] if len(texts[r.doc_id]) <= 20000 else texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(own))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(map(str, own))).encode()).hexdigest()
        assert r.contaminated == (len(own) >= 2)


ITEMS = [(1, "One two three four five six seven eight nine ten"), (2, "Kurz und gut"), (3, None), (4, ""), (5, "kurz, UND gut!"), (None, "lost item")]


def test_windows_spans_and_offsets(spark, odd_docs, no_docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "Say: ONE two, three four-five six seven eight! nine. kurz -- und gut"), (2, "zero two three four five six seven eight nine ten"), (3, None), (4, ""), (4, "")],
        "doc_id long, text string",
    )
    for max_nodes in (decontaminate.MAX_NODES, 300):  # one automaton, and several
        assert (len(decontaminate.parts_of(bench, max_nodes)) > 1) == (max_nodes == 300)
        got = sorted(decontaminate.contamination(docs, bench, max_nodes).collect(), key=lambda r: r.doc_id)
        assert [(r.doc_id, r.n_words, [tuple(s) for s in r.spans], list(r.items)) for r in got] == [
            (1, 13, [(1, 13)], [1, 2, 5]), (2, 10, [(1, 10)], [1]), (3, 0, [], []), (4, 0, [], []), (4, 0, [], []),
        ]
        assert [tuple(c) for c in got[0].chars] == [(5, 68)]
    assert decontaminate.contamination(odd_docs, bench).count() == odd_docs.count()
    assert decontaminate.contamination(no_docs, bench).count() == 0
    assert all(r.items == [] for r in decontaminate.contamination(docs, bench.limit(0)).collect())
    for max_nodes in (decontaminate.MAX_NODES, 300):
        kept = {r.doc_id: r.text for r in decontaminate.decontaminated(docs, bench, max_nodes=max_nodes).collect()}
        assert 1 not in kept and kept[2] == "zero " and kept[3] is None and kept[4] == ""
    whole = spark.createDataFrame([(9, "so one two three four five six seven eight nine ten"), (10, "eight nine ten")], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.decontaminated(whole, bench).collect()] == [10]


def test_short_items_alone_drop_no_document(spark):
    eight = "one two three four five six seven eight"
    bench = spark.createDataFrame([(1, "yes"), (2, "kurz und gut"), (3, eight)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Oh yes, that is so"), (2, "yes: kurz und gut"), (3, f"so {eight}"), (4, "nothing")], "doc_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.decontaminated(docs, bench).collect()) == [1, 4]


@pytest.mark.parametrize("seed", range(3))
def test_scan_equals_brute_force_on_random_words(seed):
    rng = random.Random(seed)
    for _ in range(80):
        items = [(i, " ".join(rng.choice("abé") for _ in range(rng.randrange(14)))) for i in range(4)]
        text = ", ".join(rng.choice(["A", "b", "É", "é"]) for _ in range(rng.randrange(60)))
        n, spans, own = decontaminate.Windows(items).scan(text)
        assert (n, sum(b - a for a, b in spans), set(own)) == brute_hits(text, items)


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(wins)
    cov = {i + k for i, w in enumerate(wins) if many[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cov)


def test_quality_counts_and_verdicts(spark, sf, texts):
    got = quality.query(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = [r.kept for r in got if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in got if labels.get(r.doc_id) == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.1 * len(bad)
    # the verdict is the base rule's and the share of characters in the lines that the best labelling marks content
    field = quality.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    for r in got:
        lines = [x for x in (texts[r.doc_id] or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        marks = best_labels(field, np.array(quality.line_features((texts[r.doc_id] or "").encode())[1]).reshape(-1, quality.N_FEATURES))
        share = sum(len(x) for x, m in zip(lines, marks) if m) / max(1, sum(map(len, lines)))
        assert math.isclose(r.content_share, share) and r.kept == (not r.base_failed and share >= quality.CONTENT_SHARE)


def best_labels(field, x):
    """The labelling of largest score, by best scores from the end (ties: content)."""
    if not len(x):
        return []
    score, ahead = x @ field.w, [(0.0, 0.0)]
    for i in range(len(x) - 1, 0, -1):
        ahead.append(tuple(max(field.trans[a, b] + b * score[i] + ahead[-1][b] for b in (1, 0)) for a in (0, 1)))
    ahead.reverse()
    out = [max((1, 0), key=lambda b: b * score[0] + ahead[0][b])]
    for i in range(1, len(x)):
        out.append(max((1, 0), key=lambda b: field.trans[out[-1], b] + b * score[i] + ahead[i][b]))
    return out


def test_long_documents_are_in_the_sample():
    raw = "\n".join(f"line {i}" for i in range(1000)).encode()
    assert quality.sampled(raw).shape == (quality.TRAIN_LINES, quality.N_FEATURES)
    assert quality.sampled(b"one\ntwo").shape == (2, quality.N_FEATURES)
    assert quality.line_features("é| B3 ün".encode())[0] == [8]


def test_quality_counts_of_random_texts():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", " ", "\n", "\x0b", "#", "é", "\u2003", "a b c "]) for _ in range(rng.randrange(80)))
        assert quality.counts(text) == brute_counts(text), repr(text)


def test_quality_of_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, None), (None, 1)], "doc_id long, quality int")
    field = quality.fit(odd_docs, labels)
    got = quality.judged(odd_docs, field).collect()
    assert len(got) == odd_docs.count() and not any(r.kept for r in got if r.doc_id in (1, 2, 3, 4, 5))
    assert quality.judged(no_docs, field).count() == 0
    kept = quality.kept_rows(odd_docs, field)
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.kept}


def test_viterbi_and_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    for t in (1, 2, 5):
        field = quality.Field(rng.normal(size=quality.N_FEATURES), rng.normal(size=(2, 2)))
        x = rng.normal(size=(t, quality.N_FEATURES))
        score = x @ field.w
        paths = [[k >> i & 1 for i in range(t)] for k in range(1 << t)]
        value = np.array([sum(s * y for s, y in zip(score, p)) + sum(field.trans[a, b] for a, b in zip(p, p[1:])) for p in paths])
        assert field.decode(x) == paths[int(value.argmax())]
        node, pairs, logz = quality.Field._marginals(score[None], field.trans, np.ones((1, t), bool))
        weight = np.exp(value - value.max())
        share = weight / weight.sum()
        assert np.allclose(node[0], (share[:, None] * np.array(paths)).sum(0))
        assert np.allclose(logz[0], value.max() + np.log(weight.sum()))
        for a in (0, 1):
            for b in (0, 1):
                assert np.isclose(pairs[0, a, b], sum(s * sum((x, y) == (a, b) for x, y in zip(p, p[1:])) for s, p in zip(share, paths)))


def brute_secrets(text):
    kinds = [
        ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 12),
        ("access", "AKIA[A-Z0-9]+", 0, 0, 18),
        ("hex", "[0-9a-f]+", 0, 0, 16),
    ]
    found = [(m.start(), k, name, m.end()) for k, (name, p, f, g, least) in enumerate(kinds) for m in re.finditer(p, text or "", f) if len(m[g]) >= least]
    return ",".join(f"{name}:{s}:{e}" for s, _, name, e in sorted(found))


def test_secrets_equal_brute_force(spark, sf, texts):
    got = secrets.query(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute_secrets(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(want.count(k) for k in ("assign", "access", "hex"))


def test_secrets_of_random_texts():
    rng = random.Random(6)
    parts = ["password", "PassWD", "secret", "token", "api_key", "apikey", "ſecret", "toKen", ":", "=", " ", '"', "'", "abc", "0123456789abcdef", "AKIA", "ABCDEFGH12", "x", "/+", "é", "\n"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        assert secrets.named(secrets.base_spans(text)) == brute_secrets(text), repr(text)


def test_guess_costs():
    weak = ("changeme123", "password1", "qwertyuiop", "aaaaaaaaaaaa", "20240131", "abcabcabcabc", "Summer2023", "hunter2hunter2", "12345678",
            "secretuvwxyz1", "summertyuiop1", "masterstuvwx1")
    strong = ("x7#Kq!9zLp2@", "vR8$tY1&wZ0^", "Tg5-bX9q_Lm2", "9f!Qz7*Kd3(Wp")
    assert max(map(SCANNER.cost, weak)) < secrets.MIN_GUESSES <= min(map(SCANNER.cost, strong))
    text = "db pwd = x7#Kq!9zLp2@ and passphrase: changeme123; the pass is open, PASSWORD=abcdefghijkl0"
    kinds = [secrets.KINDS[k] for _, k, _ in SCANNER.spans(text)]
    assert kinds == ["guess", "assign"]
    assert "x7#Kq" not in SCANNER.redact(text) and "changeme123" in SCANNER.redact(text)


def test_keywords_inside_identifiers_and_letters_only():
    key = "i2WqFCPYgb1BWaCUo85bbI8ynBboCFoooDsb1JPl"
    found = (
        ("AWS_SECRET_ACCESS_KEY=", key), ("aws_secret_access_key = ", key), ("DB_PASSWORD=", "Xy7$kq9!vT2#pL"), ("db_pwd: ", "Xy7$kq9!vT2#pL"),
        ("MYSQL_PWD=", "kf83hgka93jhgA"), ("pwd=", "QzXkWvBnMpLrTy"), ("clientSecretKey: ", "Xy7$kq9!vT2#pL"), ("DB_PASS=", "Xy7$kq9!vT2#pL"),
    )
    for name, value in found:
        text = f"so {name}{value} it"
        assert secrets.named(SCANNER.spans(text)) == f"guess:{3 + len(name)}:{3 + len(name) + len(value)}", text
        assert value not in SCANNER.redact(text)
    for text in ("the secret is extraordinarily good", "secretary: Washington", "The password is responsibility", "passengers: beautiful-old-harbour", "api_key=YOURKEYHERE"):
        assert SCANNER.spans(text) == []
    assert SCANNER.spans("password_" * 5000 + "token" * 5000) == []


def test_guessed_spans_reach_beyond_base_spans():
    text = "so password=Tr0ub4dorXyz&9kQ!vT2#pLmz it"
    assert secrets.named(SCANNER.spans(text)) == "assign:3:24,guess:12:37"
    assert SCANNER.redact(text) == "so [SECRET] it"
    text = "so pwd: x!0123456789abcdef0!Kq$z it"
    assert [secrets.KINDS[k] for _, k, _ in SCANNER.spans(text)] == ["guess", "hex"] and SCANNER.redact(text) == "so pwd: [SECRET] it"
    text = "so token = '0123456789abcdef0123' it"
    assert "guess" not in secrets.named(SCANNER.spans(text))


def brute_cost(value):
    """The least sum over every segmentation, segment by segment."""
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = low.translate(secrets._SWAPS)
    brute = math.log10(secrets._alphabet(value))

    def costs(i, j):
        part, size = value[i:j], j - i
        if size == 1:
            yield brute
        steps = {ord(b) - ord(a) for a, b in zip(part, part[1:])}
        if size >= 3 and steps == {0}:
            yield secrets.run_cost(0, size, brute)
        if size >= 3 and steps in ({1}, {-1}):
            yield secrets.run_cost(1, size, brute)
        if size >= 4 and all(b in secrets._NEAR.get(a, "") for a, b in zip(low[i:j], low[i + 1 : j])):
            yield secrets.run_cost(2, size, brute)
        if size >= 3 and plain[i:j] in SCANNER.ranks:
            yield secrets.word_cost(SCANNER.ranks[plain[i:j]], part, plain[i:j])
        if secrets._DATE.fullmatch(part):
            yield 2.0 if size == 4 else 4.3
        if 2 <= size <= 8 and i >= size and value[i - size : i] == part:
            yield 0.6

    best = [0.0] + [math.inf] * len(value)
    for j in range(1, len(value) + 1):
        best[j] = min(best[i] + c for i in range(j) for c in costs(i, j))
    return best[-1]


def test_guess_cost_equals_exhaustive_search():
    rng = random.Random(12)
    parts = ["secret", "Pa$$word", "uvwxyz", "zyx", "qwertyuiop", "aaaa", "1111111", "2024", "2023-01-31", "x7", "K", "#", "sun", "abcabc", "a", "İ", "tyu", "the"]
    for _ in range(1500):
        value = "".join(rng.choice(parts)[: rng.choice((2, 5, 12))] for _ in range(rng.randrange(1, 6)))
        value += "".join(rng.choice("aab1") for _ in range(rng.randrange(6)))
        want = brute_cost(value)
        assert math.isclose(SCANNER.cost(value), want), value
        assert (SCANNER.cost(value, 8.0) >= 8.0) == (want >= 8.0), value
    assert SCANNER.cost("a" * 5000) < 8 and SCANNER.cost("qwerty" * 500, 8.0) >= 8


def test_letters_alone_can_be_secrets():
    for text, found in (("pwd: kqzvxwjhmtrb", 1), ("passphrase: correcthorsebattery", 1), ("password is secretuvwxyz1", 0)):
        assert len(SCANNER.spans(text)) == found, text


def test_secrets_of_odd_documents(spark, odd_docs, no_docs):
    assert secrets.scanned(odd_docs).count() == odd_docs.count()
    assert secrets.scanned(no_docs).count() == 0
    clean = secrets.redacted(odd_docs)
    assert clean.columns == odd_docs.columns and sorted(str(r) for r in clean.collect()) == sorted(str(r) for r in odd_docs.collect())


def test_language_held_out_accuracy(spark, sf):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in language.query(spark, sf).collect()]
    assert len(got) == len(lang) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def brute_mixture(model, text):
    """Plain expectation-maximisation over every set, language by language."""
    _, lang, bucket, n = model.parts
    counts = [Counter() for _ in model.names]
    for k, b, c in zip(lang, bucket, n):
        counts[k][int(b)] = int(c)
    grams = Counter(int(g) for g in language.grams(text))
    p = {g: [(c[g] + language.SMOOTHING) / (sum(c.values()) + language.SMOOTHING * language.BUCKETS) for c in counts] for g in grams}
    total = sum(grams.values())

    def em(own):
        share = [1 / len(own)] * len(own)
        for _ in range(language.EM_STEPS):
            new = [0.0] * len(own)
            for g, c in grams.items():
                z = sum(s * p[g][k] for s, k in zip(share, own))
                for i, k in enumerate(own):
                    new[i] += c * share[i] * p[g][k] / z
            share = [x / total for x in new]
        return share, sum(c * math.log(sum(s * p[g][k] for s, k in zip(share, own))) for g, c in grams.items())

    every = list(range(len(model.names)))
    share, _ = em(every)
    order = [k for k in sorted(every, key=lambda k: -share[k]) if share[k] >= language.MIN_SHARE]
    sets = [[k] for k in every] + [order[:k] for k in range(2, len(order) + 1)]
    best = max(sets, key=lambda own: em(own)[1] - language.PENALTY * math.log(total) * (len(own) - 1))
    found = sorted(zip([-s for s in em(best)[0]], best))
    return [model.names[k] for _, k in found], [-s for s, _ in found]


def test_mixtures_equal_brute_force(spark, sf, texts):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.fit(docs)
    rng = random.Random(3)
    some = [t for t in texts.values() if t]
    for _ in range(12):
        text = rng.choice(some)[:400] + " " + rng.choice(some)[:rng.choice((0, 100, 400))]
        name, score, names, shares = model.infer(text)
        want, own = brute_mixture(model, text)
        assert names == want and np.allclose(shares, own) and name == want[0] and math.isclose(score, own[0])


def test_every_language_is_learned(spark):
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(110 - i % 13)} " * 30, f"l{i:03d}") for i in range(500)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.names) == 500 and model.infer(rows[499][1])[0] == "l499"


def test_language_mixtures(spark, odd_docs, no_docs):
    en, de = "the and of that with this from they", "der und die das nicht mit sich auf"
    rows = [(i, " ".join(random.Random(i).choices((en if i % 2 else de).split(), k=60)), "en" if i % 2 else "de") for i in range(60)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.names == ["de", "en"]
    name, score, names, shares = model.infer(en * 4 + " " + de * 12)
    assert name == "de" and set(names) == {"de", "en"} and 0.6 < score < 0.9 and abs(sum(shares) - 1) < 1e-6
    assert model.infer(en * 5)[2] == ["en"]
    assert [model.infer(t)[0] for t in (None, "", "12 !?")] == ["und"] * 3
    got = language.identified(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert language.identified(no_docs, model).count() == 0
    assert language.fit(no_docs).infer("text")[0] == "und"
