"""Quality rules, rule ensemble, toxicity, pseudonyms and decontamination."""

import datetime
import hmac
import re
import zlib

import numpy as np
import pytest

from webcorpus.llm import decontaminate, pii, quality, rules, toxicity
from webcorpus.llm.texts import WordHashes, flat_words

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^ \t-\r]+", text or "")


# -- quality rules -------------------------------------------------------------------


def brute_stats(text):
    text = text or ""
    w = words(text)
    triples = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    covered = {k + d for k, t in enumerate(triples) if triples.count(t) > 1 for d in range(3)}
    lines, dup = [], 0
    for line in text.split("\n"):
        if words(line):
            dup += line in lines
            lines.append(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered))


@pytest.mark.parametrize(
    "text",
    [None, "", " \n ", "a", "a b a b a b c", "x y z\nx y z\n \nq\nx y z", "é#|<>% \v\f a\r\nb", "t t t t"],
)
def test_base_statistics(text):
    flat, bounds = flat_words([text or "", "x y z x y z", ""])
    stats = quality.base_stats([text or "", "x y z x y z", ""], flat, bounds, WordHashes(4).array(flat))
    assert tuple(int(stats[c][0]) for c in quality.STATS) == brute_stats(text)
    assert tuple(int(stats[c][1]) for c in quality.STATS) == brute_stats("x y z x y z")


def test_quality_of_odd_rows(make_docs, odd_rows, make_labels):
    odd_rows = [*odd_rows, (9, " ".join(f"w{k}" for k in range(90)))]
    docs, labels = make_docs(odd_rows), make_labels([(9, 1, 0), (7, 1, 0), (7, 1, 0), (99, 1, 1), (6, None, 0)])
    ratios = quality.fit_ratios(docs, labels)
    found = quality.score_quality(docs, ratios).collect()
    assert len(found) == len(odd_rows)
    by_id = {r.doc_id: r for r in found}
    for doc_id, text, *_ in odd_rows:
        if len(text or "") < 1_000:
            assert by_id[doc_id].n_words == len(words(text))
    assert not any(by_id[k].kept for k in (1, 2, 3, 4, 7, 8)) and by_id[9].kept
    kept = quality.select_kept(docs, ratios)
    assert kept.schema == docs.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r.doc_id) for r in found if r.kept
    )


def test_all_good_documents_are_trusted(spark):
    docs = spark.range(20_100).selectExpr("id as doc_id", "'a b' as text")
    labels = docs.selectExpr("doc_id", "1 as quality", "0 as toxic")
    counts = quality.ngram_counts(docs, labels).agg({"raw": "sum", "trusted": "sum"}).first()
    assert sorted(counts) == [3 * 20_100] * 2


def test_texts_move_as_codes_with_one_plan(spark, make_docs, make_labels):
    docs, labels = make_docs([(1, "a b c")]), make_labels([(1, 1, 0)])
    plans = []
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        plans.append(quality.ngram_counts(docs, labels)._jdf.queryExecution().sparkPlan().toString())
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("SortMergeJoin" in plan and "Broadcast" not in plan for plan in plans)
    joined = plans[0].split("SortMergeJoin")[1]
    assert "codes" in joined and "text" not in joined.split("MapInArrow")[0]


def test_quality_without_labels_or_rows(make_docs, make_labels):
    docs = make_docs([(1, " ".join(f"w{k}" for k in range(60)))])
    ratios = quality.fit_ratios(docs, make_labels([]))
    assert quality.score_quality(docs, ratios).first().kept  # all ratios are 0
    none = make_docs([])
    assert quality.score_quality(none, quality.fit_ratios(none, make_labels([]))).count() == 0


# -- classifiers ------------------------------------------------------------------------


def outcome(spark, found, label, folds, fold):
    rows = found.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    return sum(r.predicted == r[label] for r in held) / len(held)


def test_rules_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    assert outcome(spark, rules.classify(docs, labels), "quality", 4, 2) >= 0.95


def test_compiled_rules_are_the_model(spark):
    rng = np.random.default_rng(1)
    x = rng.random((400, 2)) * 10
    y = ((x[:, 0] > 4) & (x[:, 1] <= 7)).astype(float)
    model = rules.fit(x, y, ["n_words", "word_length"])
    rows = [(int(a), int(b * max(int(a), 1))) for a, b in x]
    names = rules.STATS
    stats = spark.createDataFrame(
        [(a, b, *[0] * (len(names) - 2)) for a, b in rows], ", ".join(f"{n} long" for n in names)
    )
    score = [r.s for r in stats.select(rules.compiled(model).alias("s")).collect()]
    value = {"n_words": [a for a, _ in rows], "word_length": [b / max(a, 1) for a, b in rows]}
    for k, s in enumerate(score):
        total = model.bias + sum(
            rule.weight
            for rule in model.rules
            if all((value[n][k] > edge) == above for n, above, edge in rule.terms)
        )
        assert s == pytest.approx(1 / (1 + np.exp(-total)))
    guess = [s >= 0.5 for s in score]
    assert np.mean([g == bool(t) for g, t in zip(guess, y)]) > 0.9


def test_toxicity_finds_words_and_spellings():
    """Toxic stems stand among common words; unseen forms share their spelling."""
    rng = np.random.default_rng(5)
    stems, letters = ["grolk", "vrexx"], list("abcdeimnorst")
    common = ["".join(rng.choice(letters, 4)) for _ in range(150)]

    def text(toxic):
        out = [common[k] for k in rng.integers(0, 150, 90)]
        for _ in range(4 if toxic else 0):
            out[rng.integers(90)] = stems[rng.integers(2)] + "".join(rng.choice(letters, 2))
        return out

    labels = np.arange(240) % 2
    windows, owner = [], []
    for k, label in enumerate(labels):
        w = text(label)
        windows += [w[a : a + toxicity.WINDOW] for a in toxicity.starts(len(w))]
        owner += [k] * len(toxicity.starts(len(w)))
    model = toxicity.train(windows, np.array(owner), labels)
    scorer = toxicity.Scorer(model)
    scores = scorer.scores([" ".join(text(k % 2)) for k in range(100)] + ["", "short one"])
    right = [(s >= 0.5) == (k % 2 == 1) for k, s in enumerate(scores[:100])]
    assert np.mean(right) >= 0.9
    assert ((scores >= 0) & (scores <= 1)).all() and scores[100] < 0.5


def test_toxicity_learns_from_whole_long_and_short_texts(make_docs, make_labels):
    """One word in a long text makes it toxic; a short one is a window of its own."""
    rng = np.random.default_rng(6)
    common = [f"plain{k}" for k in range(60)]

    def text(k):
        out = [common[j] for j in rng.integers(0, 60, 1500 if k % 4 < 2 else 12)]
        if k % 2:
            out[len(out) * 3 // 7] = "grolkish"
        return " ".join(out)

    rows = [(k, text(k)) for k in range(160)]
    labels = make_labels([(k, None, k % 2) for k in range(160)])
    words, windows, toxic, _ = toxicity.training_texts(make_docs(rows), labels, 5, 0)
    place = np.flatnonzero(windows.ids == words.index("grolkish"))
    assert len(place) == toxic.sum()
    seen = [((windows.first <= at) & (at < windows.first + windows.size)).any() for at in place]
    assert all(seen)
    model = toxicity.learn(words, windows, toxic)
    scores = toxicity.Scorer(model).scores([t for _, t in rows])
    right = [(s >= 0.5) == k % 2 for k, s in enumerate(scores)]
    assert np.mean(right) >= 0.95


def test_the_curve_keeps_the_share_of_toxic_documents(make_docs, make_labels, monkeypatch):
    """A sample with as many documents of each class stands for all labelled ones."""
    monkeypatch.setattr(toxicity, "MAX_PER_CLASS", 50)
    rng = np.random.default_rng(4)
    rows, label = [], []
    for k in range(600):
        label.append(int(k % 8 == 0))
        out = [f"plain{j}" for j in rng.integers(0, 60, 32)]
        if rng.random() < (0.8 if label[k] else 0.2):  # no word tells for certain
            out[rng.integers(32)] = "grolkish"
        rows.append((k, " ".join(out)))
    labels = make_labels([(k, None, x) for k, x in enumerate(label)])
    words, windows, toxic, stands = toxicity.training_texts(make_docs(rows), labels, 5, 0)
    learnt = [x for k, x in enumerate(label) if zlib.crc32(str(k).encode()) % 5]
    assert len(toxic) == 100 and stands.sum() == pytest.approx(len(learnt))
    assert (stands * toxic).sum() == pytest.approx(sum(learnt))
    model = toxicity.learn(words, windows, toxic, stands)
    texts = [" ".join(words[j] for j in row) for row in windows.ids.reshape(100, 32)]
    curve = np.arange(100) % toxicity.CURVE_EVERY == 0
    score = toxicity.Scorer(model).scores(texts)[curve]
    wanted = np.average(toxic[curve], weights=stands[curve])
    assert np.average(score, weights=stands[curve]) == pytest.approx(wanted, abs=0.02)


def test_padding_changes_no_window():
    rng = np.random.default_rng(3)
    p = toxicity.new_network(rng)
    lexicon = toxicity.Lexicon().rows([f"w{k}" for k in range(6)])
    gates = toxicity.inputs(p, *lexicon) @ p["W"] + p["b"]
    shut = np.zeros((2, 1, 3 * toxicity.HIDDEN), np.float32)
    shut[..., : toxicity.HIDDEN] = toxicity.SHUT
    ids = rng.integers(0, 6, (4, 5))
    longer = np.concatenate([ids, np.full((4, 27), 6)], axis=1)
    alone = toxicity.run_windows(p, gates, ids)[0]
    padded = toxicity.run_windows(p, np.concatenate([gates, shut], axis=1), longer, 6)[0]
    assert padded == pytest.approx(alone, abs=1e-5)


def test_toxicity_gradients():
    rng = np.random.default_rng(2)
    p = {n: v.astype(np.float64) for n, v in toxicity.new_network(rng).items()}
    ids = rng.integers(0, 5, (3, 4))
    gates = rng.normal(size=(2, 5, 3 * toxicity.HIDDEN))
    target = np.array([0.0, 1.0, 1.0])

    def loss():
        logit, _ = toxicity.run_windows(p, gates, ids)
        return float(np.sum(np.logaddexp(0, logit) - target * logit))

    logit, kept = toxicity.run_windows(p, gates, ids)
    g, d_gates = toxicity.gradients(p, kept, 1 / (1 + np.exp(-logit)) - target, 5)
    for name, array, grad in [("U", p["U"], g["U"]), ("A", p["A"], g["A"]), ("v", p["v"], g["v"]),
                              ("w", p["w"], g["w"]), ("gates", gates, d_gates)]:
        at = tuple(rng.integers(0, n) for n in array.shape)
        old = array[at]
        array[at] = old + 1e-3
        up = loss()
        array[at] = old - 1e-3
        down = loss()
        array[at] = old
        assert grad[at] == pytest.approx((up - down) / 2e-3, rel=2e-2, abs=2e-3), name


def test_windows_cover_all_words():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        covered = {k for a in toxicity.starts(n) for k in range(a, min(n, a + toxicity.WINDOW))}
        assert covered == set(range(n))


@pytest.mark.parametrize("classify", [rules.classify, toxicity.classify])
def test_classifiers_on_odd_rows_and_few_labels(make_docs, odd_rows, make_labels, classify):
    found = classify(make_docs(odd_rows), make_labels([(7, 1, 1), (5, 0, 0), (None, 1, 1), (6, None, None)]))
    rows = found.collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert classify(make_docs([]), make_labels([])).count() == 0


def plain_statistics(text):
    """The inputs of the rules from a raw text."""
    text = text or ""
    n_words, word_chars, symbols, dup, repeated = brute_stats(text)
    found, n, lines = words(text), max(n_words, 1), text.count("\n") + 1
    return {
        "n_words": n_words, "word_length": word_chars / n, "symbols": symbols / n, "bars": text.count("|") / n,
        "dup_lines": dup / lines, "repeated": repeated / n, "distinct": len(set(found)) / n, "stops": text.count(".") / n,
        "commas": text.count(",") / n, "line_words": n_words / lines, "blank": 1 - word_chars / max(len(text), 1),
    }


def test_rule_scores_are_those_of_a_plain_scorer(spark, make_docs, make_labels, odd_rows):
    """Rule by rule over raw texts, from the model that the query learns."""
    rng = np.random.default_rng(3)

    def text(k):
        parts = [f"w{j}" + rng.choice(["", "", ",", "."]) for j in rng.integers(0, 40, rng.integers(5, 90))]
        return " ".join([*parts, *["|", "###"] * (k % 2 * rng.integers(0, 9))]) + "\nline" * rng.integers(0, 4)

    rows = [(k, text(k)) for k in range(400)] + [(r[0], r[1]) for r in odd_rows[:6]] + [(5, "another | text")]
    docs, labels = make_docs(rows), make_labels([(k, int(k % 2 == 0), 0) for k in range(400)])
    model = rules.learn(rules.text_stats(docs), labels, "quality", 4, 2)
    assert model.rules
    wanted = []
    for doc_id, raw in rows:
        x, total = plain_statistics(raw), model.bias
        for rule in model.rules:
            total += rule.weight * all((x[name] > edge) == above for name, above, edge in rule.terms)
        held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2
        wanted.append((doc_id, held, 1 / (1 + np.exp(-total))))
    found = [(r.doc_id, r.held_out, r.score) for r in rules.classify(docs, labels).collect()]
    found.sort(key=str), wanted.sort(key=str)
    assert [r[:2] for r in found] == [r[:2] for r in wanted]
    assert [r[2] for r in found] == pytest.approx([r[2] for r in wanted], abs=1e-9)


def plain_toxicity(model, text):
    """The recurrent cell word by word over every window, in both directions."""
    p, h = model.network, toxicity.HIDDEN
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    lexicon, worst = toxicity.Lexicon(), []
    found = words(text)
    x = []
    for w in found:
        row, chars, _ = lexicon.rows([w])
        x.append(np.concatenate([p["words"][row[0]], p["chars"][chars].mean(0)]).astype(float))
    last = max(0, len(found) - toxicity.WINDOW)
    for first in sorted({*range(0, last, toxicity.STRIDE), last} if found else ()):
        window = x[first : first + toxicity.WINDOW]
        both = []
        for way in (0, 1):
            state, states = np.zeros(h), []
            for v in window[:: 1 - 2 * way]:
                gate, own = v @ p["W"][way] + p["b"][way, 0], state @ p["U"][way]
                z, r = sigmoid(gate[:h] + own[:h]), sigmoid(gate[h : 2 * h] + own[h : 2 * h])
                state = z * state + (1 - z) * np.tanh(gate[2 * h :] + r * own[2 * h :])
                states.append(state)
            both.append(states[:: 1 - 2 * way])
        states = np.concatenate([np.array(both[0]), np.array(both[1])], axis=1)
        energy = np.exp(np.tanh(states @ p["A"]) @ p["v"])
        worst.append((energy / energy.sum()) @ states @ p["w"] + p["c"][0])
    return sigmoid(model.slope * max(worst, default=model.lowest) + model.bias)


def test_toxicity_scores_are_those_of_a_plain_network(make_docs, make_labels, odd_rows):
    rng = np.random.default_rng(8)

    def text(k):
        out = [f"plain{j}" for j in rng.integers(0, 50, rng.integers(1, 140))]
        if k % 3 == 0:
            out[rng.integers(len(out))] = "Grolkish!"
        return " ".join(out)

    rows = [(k, text(k)) for k in range(90)] + [(r[0], r[1]) for r in odd_rows if len(r[1] or "") < 2_000]
    docs, labels = make_docs(rows), make_labels([(k, None, int(k % 3 == 0)) for k in range(90)])
    samples = [toxicity.training_texts(docs.repartition(n), labels, 5, 0) for n in (1, 7)]
    assert samples[0][0] == samples[1][0] and (samples[0][1].ids == samples[1][1].ids).all()
    model = toxicity.learn(*samples[0])
    assert model.network is not None
    found = sorted(((r.doc_id, r.score) for r in toxicity.classify(docs, labels).collect()), key=str)
    wanted = sorted(((doc_id, plain_toxicity(model, raw)) for doc_id, raw in rows), key=str)
    assert [r[0] for r in found] == [r[0] for r in wanted]
    assert [r[1] for r in found] == pytest.approx([r[1] for r in wanted], abs=1e-4)


# -- pseudonyms ---------------------------------------------------------------------------

SAMPLES = [
    "Call +1 (366) 555-9807 or (212) 555-1234, 212-555-1234, +442071234567",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1111 or 378282246310005",
    "from joe.smith.42@mail8.example.com, at 42.144.35.254.",
    "on 2020-02-29, 13/02/1999, 02/13/1999, 1.1.2000 and 05/06/2007",
    "DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, 078-05-1120",
]


@pytest.mark.parametrize("text", SAMPLES)
def test_pseudonyms_go_back_and_stay_valid(text):
    there, back = pii.Masker(b"key"), pii.Masker(b"key", back=True)
    masked, counts = there.mask(text)
    assert masked != text and back.mask(masked) == (text, counts)
    assert there.mask(masked)[1] == counts  # still valid values of the same kinds
    assert pii.Masker(b"other").mask(text)[0] != masked


def test_equal_values_stay_linked_and_others_apart():
    masker = pii.Masker(b"key")
    a = masker.mask("x 4111 1111 1111 1111 y")[0]
    b = masker.mask("4111111111111111")[0]
    assert a.replace(" ", "")[1:-1] == b
    images = {pii.Permuter(b"k").number(x, 1000, "t") for x in range(1000)}
    assert images == set(range(1000))


def test_a_phone_number_is_the_same_in_all_notations():
    masker, back = pii.Masker(b"key"), pii.Masker(b"key", back=True)
    groups = [
        ["+44 20 7946 0958", "+442079460958", "+44-20-7946-0958", "+44 (20) 7946 0958"],
        ["+1 212 555 1234", "+12125551234", "(212) 555-1234", "212-555-1234"],
        ["+380 44 537 0000", "+380445370000", "+380 (44) 537-0000", "+380.44.537.0000"],
    ]
    for group in groups:
        made = [masker.mask(f"call {text}, please")[0][5:-8] for text in group]
        digits = {re.sub(r"\D", "", m)[-9:] for m in made}
        assert len(digits) == 1 and all(m != text for m, text in zip(made, group))
        assert [back.mask(m)[0] for m in made] == group
        assert [re.sub(r"\d", "0", m) for m in made] == [re.sub(r"\d", "0", text) for text in group]


def test_dates_go_back_in_their_form():
    masker, back = pii.Masker(b"key"), pii.Masker(b"key", back=True)
    rng, seen = np.random.default_rng(7), set()
    for n in rng.integers(0, 73_000, 3_000).tolist():
        d = datetime.date.fromordinal(datetime.date(1900, 1, 1).toordinal() + n)
        forms = [d.isoformat(), f"{d.day}/{d.month}/{d.year}", f"{d.day:02}.{d.month:02}.{d.year}", f"{d.month}/{d.day}/{d.year}", f"{d.day:02}/{d.month}/{d.year}"]
        made = [masker.mask(text)[0] for text in forms]
        assert [back.mask(m)[0] for m in made] == forms
        assert [re.sub(r"\d", "0", m) for m in made] == [re.sub(r"\d", "0", text) for text in forms]
        y, m, day = made[0].split("-")
        assert made[2] == f"{day}.{m}.{y}"  # equal widths, equal dates
        seen.add(made[0])
    assert len(seen) > 2_800


def table(size, allowed, tweak, key):
    """A keyed permutation as a table, from a plain network of four lines."""
    a = next(k for k in range(1, size + 1) if k * k >= size)
    b = -(-size // a)

    def step(x):
        high, low = x // a, x % a
        for turn in range(pii.ROUNDS):
            half = low if turn % 2 else high
            f = int.from_bytes(hmac.new(key, f"{tweak}|{size}|{turn}|{half}".encode(), "sha256").digest()[:16], "big")
            high, low = ((high + f) % b, low) if turn % 2 else (high, (low + f) % a)
        return high * a + low

    once = [step(x) for x in range(a * b)]
    out = {}
    for x in filter(allowed, range(size)):
        y = once[x]
        while y >= size or not allowed(y):
            y = once[y]
        out[x] = y
    return out


def test_pseudonyms_are_those_of_a_plain_version(make_docs):
    """Values one by one, with tables of the permutations and strings put together by hand."""
    key, rows, wanted = b"key", [], []
    first = datetime.date(1900, 1, 1).toordinal()
    dates = table(datetime.date(2100, 1, 1).toordinal() - first, lambda n: True, "date", key)
    for k in range(40):
        d = datetime.date(1950 + k, 1 + k % 12, 1 + k % 28)
        new = datetime.date.fromordinal(first + dates[d.toordinal() - first])
        rows.append((k, f"born {d.isoformat()} or {d:%d.%m.%Y}, no value: {d.year}-13-01, 666-12-{k:04}"))
        wanted.append((k, f"born {new.isoformat()} or {new:%d.%m.%Y}, no value: {d.year}-13-01, 666-12-{k:04}", 2))
    cards = table(10**4, lambda n: True, "card", key)
    for n in (0, 7, 4111, 9999):
        # The same network that cards use, on a size small enough for a table.
        assert pii.Permuter(key).number(n, 10**4, "card") == cards[n]
    found = pii.pseudonymised(make_docs(rows), key).collect()
    assert sorted((r.doc_id, r.text, r.n_replaced) for r in found) == wanted


@pytest.mark.parametrize(
    "text",
    ["4111111111111112", "300.1.1.1", "2021-02-30", "v1.2.3", "666-12-1234", "a@b", "page 12 of 30",
     "@" * 5000, "1 " * 5000, "9" * 5000, "GB00WEST12345698765432", "id4111111111111111x"],
)
def test_invalid_values_stay(text):
    assert pii.Masker(b"key").mask(text)[0] == text


def test_masked_tables(make_docs, odd_rows):
    rows = odd_rows + [(90, "ip 10.20.30.40"), (91, "ip 10.20.30.40 again")]
    docs = make_docs(rows)
    masked = pii.mask_texts(docs, b"key")
    assert masked.schema == docs.schema
    by_id = {r.doc_id: r for r in masked.collect()}
    assert by_id[1].text is None and by_id[7].text == odd_rows[8][1]
    assert by_id[90].n_chars == len(by_id[90].text)
    assert by_id[91].text == by_id[90].text + " again" != rows[-1][1]
    counted = {r.doc_id: r.n_replaced for r in pii.pseudonymised(docs, b"key").collect()}
    assert counted[90] == counted[91] == 1 and counted[1] == counted[7] == 0
    assert pii.pseudonymised(make_docs([]), b"key").count() == 0


# -- decontamination --------------------------------------------------------------------------


def brute_share(text, item):
    """Best local alignment of two word lists as a share of the best possible one."""
    a, b, best = words(text), words(item), 0
    last = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, last[j - 1] + (2 if x == y else -1), last[j] - 1, row[-1] - 1))
        best, last = max(best, *row), row
    return best / (2 * len(b))


def benchmark_texts():
    rng = np.random.default_rng(8)
    return [" ".join(f"{c}{rng.integers(300)}" for _ in range(n)) for c, n in zip("abcde", (30, 8, 45, 12, 20))]


def leaking_texts():
    rng = np.random.default_rng(9)
    items, out = benchmark_texts(), []
    for k in range(60):
        filler = [f"{rng.choice(list('abcdefg'))}{rng.integers(300)}" for _ in range(80)]
        part = words(items[k % 5])
        if k % 4 == 1:  # reworded, with a word lost and one added
            part = [f"new{j}" if j % 7 == 3 else w for j, w in enumerate(part)]
            part = part[:5] + part[6:9] + ["added"] + part[9:]
        if k % 4 < 3:
            filler[40:40] = part
        out.append(" ".join(filler))
    return out


def test_leaks_are_those_of_full_alignment(spark, make_docs):
    items, texts = benchmark_texts(), leaking_texts()
    docs = make_docs(list(enumerate(texts)))
    bench = spark.createDataFrame([*enumerate(items), (50, None), (51, ""), (52, "a b")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.find_leaks(docs, bench).collect()}
    wanted = {
        (d, i): brute_share(t, x)
        for d, t in enumerate(texts)
        for i, x in enumerate(items)
        if brute_share(t, x) >= decontaminate.MIN_SCORE
    }
    assert found == pytest.approx(wanted)
    clean = decontaminate.select_clean(docs, bench)
    assert clean.schema == docs.schema
    assert {r.doc_id for r in clean.collect()} == set(range(60)) - {d for d, _ in wanted}


def test_leaks_in_several_scans_and_odd_rows(spark, make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(decontaminate, "SCAN_WORDS", 10)
    bench = spark.createDataFrame([(1, odd_rows[5][1]), (2, "q w e r t y u i o p a s d f")], "item_id int, text string")
    found = decontaminate.find_leaks(make_docs(odd_rows), bench).collect()
    assert {r.doc_id for r in found} == {5, None}  # the null id shares the prose
    none = bench.limit(0)
    assert decontaminate.find_leaks(make_docs(odd_rows), none).count() == 0
    assert decontaminate.select_clean(make_docs(odd_rows), none).count() == len(odd_rows)
    assert decontaminate.find_leaks(make_docs([]), bench).count() == 0


def edited(part, rng):
    """Words changed, lost, added or cut off, about as many as still leave half the score."""
    n, out = len(part), []
    change, lose, add = rng.dirichlet([1, 1, 1]) * rng.uniform(0, 0.5)
    for w in part:
        if rng.random() < change:
            out.append(f"new{rng.integers(10**6)}")
        elif rng.random() >= lose:
            out.append(w)
        while rng.random() < min(2 * add, 0.5):
            out.append(f"more{rng.integers(10**6)}")
    return out[: max(1, n - rng.integers(0, max(1, n // 5)))] if rng.random() < 0.3 else out


def test_every_edit_that_aligns_is_found(spark, make_docs):
    rng = np.random.default_rng(12)
    sizes = [4, 5, 6, 7, 9, 10, 12, 20, 30, 40, 60]
    items = [[f"{k}w{rng.integers(n * 4)}" if rng.random() < 0.8 else "the" for _ in range(n)] for k, n in enumerate(sizes)]
    texts = []
    for part in items:
        every = [
            ["x" if k % 3 == 2 else w for k, w in enumerate(part)],  # every third word changed
            [x for w in part for x in (w, f"y{rng.integers(99)}")],  # a word added after each
            [w for k, w in enumerate(part) if k % 4 != 3],  # every fourth lost
            part[: len(part) // 2 + 1],
        ]
        every += [edited(part, rng) for _ in range(12)]
        for copy in every:
            before = ["the" if rng.random() < 0.3 else f"f{rng.integers(500)}" for _ in range(rng.integers(60))]
            texts.append(" ".join([*before, *copy, *before[::-1]]))
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id smallint, text string")
    docs = make_docs(list(enumerate(texts)))
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.find_leaks(docs, bench).collect()}
    wanted = {}
    for d, text in enumerate(texts):
        for k in range(len(items)):
            share = brute_share(text, " ".join(items[k]))
            if share >= decontaminate.MIN_SCORE:
                wanted[d, k] = share
    assert len(wanted) > 100 and {k for _, k in wanted} == set(range(len(items)))
    assert found == pytest.approx(wanted)


def test_short_items_stand_as_they_are(spark, make_docs):
    docs = make_docs([(1, "one two three four"), (2, "one x two"), (3, "three two one"), (4, None)])
    bench = spark.createDataFrame([("a", "one two"), ("b", "three"), ("c", "two  three\nfour")], "item_id string, text string")
    found = decontaminate.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id, r.score) for r in found} == {(1, "a", 1.0), (1, "b", 1.0), (3, "b", 1.0), (1, "c", 1.0)}


def test_an_item_in_every_text_is_found(spark, make_docs):
    item = " ".join(f"leak{k}" for k in range(25))
    docs = make_docs([(k, f"own{k} text {item} end{k}") for k in range(200)])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert decontaminate.find_leaks(docs, bench).count() == 200


@pytest.mark.parametrize("n_copies", [90, 130])
def test_edited_copies_of_an_item_in_many_texts_are_found(spark, make_docs, n_copies):
    item = [f"leak{k}" for k in range(40)]
    gone = (2, 5, 8, 11, 14, 17, 20)
    early = [f"new{k}" if k in gone else w for k, w in enumerate(item)]
    late = [f"new{k}" if 39 - k in gone else w for k, w in enumerate(item)]
    rows = [(k, f"own{k} text {' '.join(item)} end{k}") for k in range(n_copies)]
    edited = [early, late, item[18:], item[:22]]
    rows += [(1000 + k, f"a b {' '.join(part)} c d") for k, part in enumerate(edited)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {r.doc_id: r.score for r in decontaminate.find_leaks(make_docs(rows), bench).collect()}
    assert found == pytest.approx({d: brute_share(t, " ".join(item)) for d, t in rows})
    assert decontaminate.select_clean(make_docs(rows), bench).count() == 0
