"""Quality rules, deduplication, sharding, joins, personal data and mixing against brute force."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from touchline.llm import exact_dedup, line_dedup, mixing, ngram_join, pii, quality_rules, sharding
from touchline.llm.common import scratch_path

# --- quality rules ---------------------------------------------------------------------------------------------------


def statistics(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    count = collections.Counter(windows)
    covered = {j for k, w in enumerate(windows) if count[w] > 1 for j in range(k, k + 5)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
        n < 10 or 100 * len(covered) > 20 * n,
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_text_statistics(odd, make, no_docs):
    rnd = random.Random(3)
    repeats = [" ".join(rnd.choices("abc", k=rnd.randint(0, 40))) + rnd.choice(["", "\n", "\nx # y\nx # y"]) for _ in range(60)]
    for docs in (odd, make(repeats), no_docs):
        rows = quality_rules.text_statistics(docs, "doc_id", "text").collect()
        assert [tuple(r[n] for n in NAMES) for r in rows] == [statistics(r.text) for r in rows]


def test_rules_find_a_planted_rule(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(3000):
        x = {f: rnd.random() for f in quality_rules.FEATURES}
        bad = x["f_symbols"] >= 0.7 and x["f_upper"] < 0.4 or x["f_digits"] >= 0.9
        rows.append((*x.values(), int(bad), i % 3 > 0))
    data = spark.createDataFrame(rows, [*quality_rules.FEATURES, "bad", "grow"])
    rules = quality_rules.learn_rules(data, least_precision=0.9)
    judged = data.withColumn("hit", quality_rules.decision_list(rules).isNotNull())
    wrong = judged.where("NOT grow AND (bad = 1) <> hit").count()
    assert rules and wrong < 0.03 * judged.where("NOT grow").count()
    assert {c.feature for r in rules for c in r.conditions} <= {"f_symbols", "f_upper", "f_digits"}


def test_verdicts(odd, labels, no_labels, no_docs):
    for known in (labels, no_labels):
        rows = quality_rules.quality_report(odd, known).collect()
        assert len(rows) == odd.count() and not any(r.kept and r.base_failed for r in rows)
        kept = quality_rules.keep_good(odd, known)
        assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in rows)
    assert all(r.kept != r.base_failed for r in rows)  # without labels the base rule decides alone
    assert quality_rules.quality_report(no_docs, labels).count() == 0


# --- exact dedup -----------------------------------------------------------------------------------------------------


def normal(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_dedup(odd, no_docs):
    rows = odd.select("doc_id", "text").collect()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[normal(r.text)].append(r.doc_id)
    top = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = [(r.doc_id, top[t := normal(r.text)], len(groups[t]), r.doc_id == top[t], hashlib.sha256(t.encode()).hexdigest()) for r in rows]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in exact_dedup.decide(odd).collect())
    kept = exact_dedup.distinct_documents(odd)
    assert kept.columns == odd.columns
    assert sorted(normal(r.text) for r in kept.collect()) == sorted(groups)
    assert exact_dedup.decide(no_docs).count() == 0 and exact_dedup.distinct_documents(no_docs).count() == 0


def test_index_lasts_over_batches(spark, make):
    path = scratch_path(spark, "index")
    first = exact_dedup.decide(make(["a", "b", "B"]), exact_dedup.DigestIndex(spark, path, 8))
    assert {(r.doc_id, r.keep_id) for r in first.collect()} == {(0, 0), (1, 2), (2, 2)}
    again = exact_dedup.DigestIndex(spark, path, 8)  # another session would open it the same way
    second = exact_dedup.decide(make([(10, "A"), (11, "c"), (12, "c")]), again)
    assert {(r.doc_id, r.keep_id, r.kept) for r in second.collect()} == {(10, 0, False), (11, 12, False), (12, 12, True)}
    assert again.rows().count() == 3
    rerun = exact_dedup.decide(make([(10, "A"), (11, "c"), (12, "c")]), again)
    assert {(r.doc_id, r.keep_id) for r in rerun.collect()} == {(10, 0), (11, 12), (12, 12)} and again.rows().count() == 3


# --- sharding --------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("n_shards", [1, 7, 40])
def test_sharding(odd, no_docs, n_shards):
    rows = sharding.shard_report(odd, n_shards).collect()
    want = sorted(str((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()))) for r in odd.collect())
    assert sorted(str((r.doc_id, r["size"], r.text_crc32)) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by[s]) for s in range(n_shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    assert sharding.shard_report(no_docs).count() == 0


def test_shuffle_moves_rows_evenly(spark, make):
    docs = make([f"text {i}" for i in range(4000)])
    path = scratch_path(spark, "shards")
    rows = sharding.shard_documents(docs, path, 4, bucket_bytes=20_000).collect()
    assert {tuple(r[c] for c in docs.columns if c != "words") for r in rows} == {tuple(r[c] for c in docs.columns if c != "words") for r in docs.collect()}
    where = {r.doc_id: r.shard * 1000 + r.slot for r in rows}
    order = [where[i] for i in range(4000)]
    assert sorted(order) == list(range(4000))
    rising = sum(a < b for a, b in zip(order, order[1:], strict=False))
    assert 1800 < rising < 2200  # a random permutation rises half the time
    quarter = collections.Counter(where[i] // 1000 for i in range(1000))
    assert all(190 < quarter[q] < 310 for q in range(4))


# --- line dedup ------------------------------------------------------------------------------------------------------


def line_brute(rows, w):
    """Kept text per (id, text), by looking at every run of lines of every length with at least w words, in order."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    first, gone = {}, collections.defaultdict(set)
    for d, (_, text) in enumerate(order):
        lines = [x for x in (text or "").split("\n") if re.search(r"\S", x)]
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                if sum(len(x.split()) for x in lines[i:j]) >= w:
                    o = first.setdefault(tuple(lines[i:j]), (d, i))
                    if o != (d, i):
                        gone[d] |= {k for k in range(i, j) if not (o[0] == d and k < o[1] + j - i)}
    out = {}
    for d, (doc_id, text) in enumerate(order):
        kept, at = [], 0
        for line in [] if text is None else text.split("\n"):
            if re.search(r"\S", line):
                at += 1
                if at - 1 in gone[d]:
                    continue
            kept.append(line)
        out[doc_id, text] = (None if text is None else "\n".join(kept), len(gone[d]))
    return out


@pytest.mark.parametrize("w", [1, 2, 3, 5, 9, 17])
def test_line_dedup(make, w):
    rnd = random.Random(w)
    texts = ["\n".join(rnd.choices(["a", "b", "c", "a long line", " six words are in this one ", "", " "], k=rnd.randint(0, 14))) for _ in range(60)]
    texts += [texts[0], None, "", "a\na\na\na\na\na", "x\ny", "x\ny", "unique\nlines\nonly", (70, "p\nq\np\nq"), (70, "p\nq\np\nq"), (None, "p\nq")]
    docs = make(texts)
    want = line_brute([(r.doc_id, r.text) for r in docs.collect()], w)
    rows = line_dedup.drop_repeated_lines(docs.withColumn("before", F.col("text")), w).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.text, len(r.removed_lines or [])) == want[r.doc_id, r.before], (r, want[r.doc_id, r.before])


def test_one_long_line_is_a_run(make):
    passage, short = " ".join(f"word{i}" for i in range(60)), "short line"
    docs = make([f"one\n{passage}\n{short}", f"two other\n{passage}", f"{short}\nthree", f"{passage}\n{passage}"])
    left = {r.doc_id: r.text for r in line_dedup.line_report(docs).collect()}
    assert left == {0: f"one\n{passage}\n{short}", 1: "two other", 2: f"{short}\nthree", 3: ""}


def test_extra_columns_keep_their_values(odd, labels):
    """Columns with the operators' own names pass through."""
    names = ["text_sha256", "removed", "n_words", "kept", "rule", "base_failed", "f_words", "shard", "slot", "__id", "word_chars", "keep_id", "bucket"]
    docs = odd.select("doc_id", "text", "lang", *[F.concat_ws("/", F.lit(n), "lang").alias(n) for n in names])
    results = {
        "exact": exact_dedup.distinct_documents(docs), "quality": quality_rules.keep_good(docs, labels),
        "lines": line_dedup.drop_repeated_lines(docs).drop("removed_lines"),
        "shards": sharding.shard_documents(docs, scratch_path(odd.sparkSession, "clash"), 3),
    }
    for kind, out in results.items():
        own = {"shard", "slot"} if kind == "shards" else set()
        assert sorted(out.columns) == sorted(docs.columns), kind
        wrong = [out[n] != F.concat_ws("/", F.lit(n), "lang") for n in names if n not in own]
        assert out.count() > 0 and all(out.where(w).isEmpty() for w in wrong), kind


def test_line_dedup_edges(odd, no_docs):
    assert line_dedup.line_report(odd).count() == odd.count()
    assert sorted(line_dedup.drop_repeated_lines(odd).drop("removed_lines").columns) == sorted(odd.columns)
    assert line_dedup.line_report(no_docs).count() == 0


# --- n-gram join -----------------------------------------------------------------------------------------------------


def grams(text):
    words = (text or "").split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def join_brute(rows, threshold=0.8):
    copies = collections.defaultdict(list)
    for r in rows:
        copies[grams(r.text)].append(r.doc_id)
    keys = list(copies)
    links = {k: [o for o in keys if o is not k and k and o and len(k & o) >= threshold * len(k | o) - 1e-9] for k in keys}
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    seen, group = set(), {}
    for k in keys:
        if k in seen:
            continue
        stack, members = [k], []
        seen.add(k)
        while stack:
            x = stack.pop()
            members.append(x)
            for o in links[x]:
                if o not in seen:
                    seen.add(o)
                    stack.append(o)
        top = least(i for x in members for i in copies[x])
        group.update(dict.fromkeys(members, top))
    return sorted(
        str((r.doc_id, group[k := grams(r.text)], least(copies[k]), len(copies[k]), len(links[k]), sum(len(copies[o]) for o in links[k])))
        for r in rows
    )


def near_copies(seed=5, groups=8, size=12):
    rnd = random.Random(seed)
    vocabulary, texts = [f"w{i}" for i in range(500)], []
    for _ in range(groups):
        words = rnd.choices(vocabulary, k=rnd.randint(8, 150))
        for _ in range(rnd.randint(1, size)):
            words = list(words)
            for _ in range(rnd.randint(0, 2)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            texts.append(" ".join(words))
    return texts + texts[:5]


def test_ngram_join(make, odd, no_docs):
    for docs in (make(near_copies()), odd, no_docs):
        got = sorted(str(tuple(r)) for r in ngram_join.link_documents(docs).collect())
        assert got == join_brute(docs.select("doc_id", "text").collect())


def test_ngram_join_in_blocks(make, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 5)
    docs = make(near_copies(9, 3, 40))
    got = sorted(str(tuple(r)) for r in ngram_join.link_documents(docs).collect())
    assert got == join_brute(docs.select("doc_id", "text").collect())


def test_common_equals_intersections():
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [{"grams": np.unique(rng.integers(0, 300, 80)).astype(np.uint64)} for _ in range(40)]
    left, right = np.arange(0, 25), np.arange(10, 40)
    want = [[len(np.intersect1d(rows[a]["grams"], rows[b]["grams"])) for b in right] for a in left]
    assert ngram_join._common(rows, left, right).tolist() == want


def test_bands_meet_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.5, 0.9), (0.9, 0.99)):
        bands, rows = ngram_join.choose_bands(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall > 1 - (1 - threshold**rows) ** (bands - 1)


def test_one_of_each_group(make, odd):
    docs = make(near_copies())
    stay = {r.class_id for r in ngram_join.link_documents(docs).collect()}
    kept = ngram_join.one_of_each_group(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(stay)
    assert ngram_join.one_of_each_group(odd).count() > 0


def test_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rnd.randrange(200, 400), rnd.randrange(200, 400)) for _ in range(120)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in ngram_join.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(x) for x in root)


# --- personal data ---------------------------------------------------------------------------------------------------


def base_brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        doubled = (int(c) * (1 + i % 2) for i, c in enumerate(reversed(s)))
        return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0

    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    spans += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return spans + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]


def test_base_spans_equal_the_patterns():
    rnd = random.Random(6)
    pieces = ["a.b@c.de", "@", ".", "x@y", "@z.com", "1.2.3.4", "256.1.1.1", "001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 123-4567", "+1", " ", "7", "ü", "-", "+", "%", "_"]
    for _ in range(4000):
        text = "".join(rnd.choices(pieces, k=rnd.randint(1, 9)))
        assert pii.base_spans(text) == base_brute(text), text


def test_long_runs_stay_linear():
    assert pii.base_spans("a" * 300_000 + " " + "1" * 300_000 + "." * 1000 + "+1" + "(" * 300_000) == []


def test_disclosing_terms(make):
    common = "the report was sent by our office to the new address on monday"
    texts = [f"{common} {i} please write to Zebulon at zeb@example.org or call" for i in range(4)]
    texts += [f"{common} and nobody wrote to office {i}" for i in range(40)]
    texts += [f"write to the office at p{i}@example.org please number {i}" for i in range(20)]
    rows = {r.doc_id: r for r in pii.spans_report(make(texts)).collect()}
    for i in range(4):
        a, b = next((m.start(), m.end()) for m in re.finditer("Zebulon", texts[i]))
        assert rows[i].spans.startswith(f"email:{texts[i].index('zeb@')}") and f"term:{a}:{b}" in rows[i].spans
        assert "office" not in [texts[i][int(x):int(y)] for _, x, y in (s.split(":") for s in rows[i].spans.split(","))]
    assert all(rows[i].spans == "" for i in range(4, 44))
    assert all(rows[i].spans.count("term") == 0 for i in range(44, 64))
    clean = {r.doc_id: r.text for r in pii.sanitise(make(texts)).collect()}
    assert "Zebulon" not in clean[0] and "zeb@" not in clean[0] and "[EMAIL]" in clean[0] and clean[10] == texts[10]


def test_terms_of_an_entity_in_one_text(make):
    texts = ["the parcel went to Zebulon at zeb@example.org on monday"] + [f"the parcel of client c{i} went out on monday" for i in range(150)]
    texts += [f"the parcel went to client c{i} at p{i}@example.org on monday" for i in range(50)]
    rows = {r.doc_id: r for r in pii.spans_report(make(texts)).collect()}
    a = texts[0].index("Zebulon")
    assert f"term:{a}:{a + 7}" in rows[0].spans.split(",") and rows[0].spans.count("term") == 1
    assert not any("term" in rows[i].spans for i in range(1, 201))
    assert "Zebulon" not in {r.doc_id: r.text for r in pii.sanitise(make(texts)).collect()}[0]


def test_terms_are_marked_wherever_they_stand(make):
    filler = "the parcel of the office went out on a monday and the client was told so in the evening"
    far = f"Li Zebulon wrote first. {filler}. {filler}. The answer is at zeb@example.org now. Zebulon agreed."
    texts = [far] + [f"{filler}. Dear Zebulon, the answer is late"] * 1
    texts += [f"{filler}. the answer of client{i} is at p{i % 900}@example.org now, and agreed first wrote {i}" for i in range(2000)]
    rows = {r.doc_id: r for r in pii.spans_report(make(texts)).collect()}
    marked = {i: [texts[i][int(a):int(b)] for k, a, b in (s.split(":") for s in rows[i].spans.split(",") if s) if k == "term"] for i in (0, 1)}
    assert marked[0] == ["Li", "Zebulon", "Zebulon"]  # of two characters, from another sentence, and again
    assert marked[1] == ["Zebulon"] and rows[1].spans.startswith("term")  # in a text without an identifier
    clean = {r.doc_id: r.text for r in pii.sanitise(make(texts)).where("doc_id < 2").collect()}
    assert "Zebulon" not in clean[0] + clean[1] and "Li " not in clean[0] and "the answer is late" in clean[1]


def test_pii_edges(odd, no_docs):
    rows = pii.spans_report(odd).collect()
    assert len(rows) == odd.count()
    assert pii.sanitise(odd).columns == odd.columns and pii.sanitise(odd).count() == odd.count()
    assert pii.spans_report(no_docs).count() == 0


# --- mixing ----------------------------------------------------------------------------------------------------------


def test_rates_meet_the_targets(spark):
    rnd = random.Random(8)
    rows = []
    for _ in range(2000):
        x = [rnd.random() ** 6 + 1e-6 for _ in range(3)]
        rows.append((rnd.randint(0, 400), [v / sum(x) for v in x]))
    data = spark.createDataFrame(rows, "n_tokens long, posteriors array<double>")
    total = sum(n for n, _ in rows)
    for weights in ([0.7, 0.1, 0.2], [0.5, 0.02, 0.48], [0.34, 0.33, 0.33]):
        fit = mixing.fit_rates(data, weights)
        rates = [r.r for r in data.select(fit.rate(F.col("posteriors")).alias("r")).collect()]
        got = [sum(n * r * p[k] for (n, p), r in zip(rows, rates, strict=True)) / total for k in range(3)]
        assert min(rates) >= 0 and all(abs(a - b) < 1e-4 * b for a, b in zip(got, weights, strict=True))
        assert all(abs(m) < 1e-5 for m in fit.misses)


def test_rates_end_at_the_least_squares_optimum(spark):
    """A target out of reach: no document is without the second domain. Plain projected gradient steps, many of them."""
    rows = [(10 + i % 7, [1 - q - s, q, s]) for i in range(60) for q, s in [((i % 5 + 2) / 20, (i % 3 + 1) / 30)]]
    data = spark.createDataFrame(rows, "n_tokens long, posteriors array<double>")
    weights, total = [0.9, 0.01, 0.09], sum(n for n, _ in rows)
    fit = mixing.fit_rates(data, weights)
    want = [w * total for w in weights]
    gram = [sum(n * p[i] * p[i] for n, p in rows) for i in range(3)]
    scale = [1 / max(g, w) for g, w in zip(gram, want, strict=True)]
    rates = [1.0] * len(rows)
    for _ in range(4000):
        miss = [sum(n * r * p[i] for (n, p), r in zip(rows, rates, strict=True)) - want[i] for i in range(3)]
        rates = [max(0.0, r - sum(p[i] * scale[i] * miss[i] for i in range(3)) / 3) for r, (_, p) in zip(rates, rows, strict=True)]
    loss = lambda m: sum(s * x * x for s, x in zip(scale, m, strict=True))
    ours = [m * w for m, w in zip(fit.misses, want, strict=True)]
    assert max(map(abs, fit.misses)) > 0.05 and loss(ours) <= loss(miss) * 1.001


def labelled_texts():
    rnd = random.Random(2)
    words, texts, labels = [f"w{i}" for i in range(200)], [], []
    for i in range(400):
        body = rnd.choices(words, k=40)
        toxic, low = i % 8 == 0, i % 8 == 1
        if toxic:
            body[rnd.randrange(40)] = rnd.choice(["slur", "insult"])
        texts.append(" ".join(w.upper() + "!!" if low else w for w in body))
        if i < 300:
            labels.append((i, 1 - low, int(toxic)))
    return texts, labels


def test_mixing(spark, make):
    texts, known = labelled_texts()
    docs, labels = make(texts), spark.createDataFrame(known, "doc_id long, quality int, toxic int")
    weights = {"clean": 0.85, "low": 0.05, "toxic": 0.1}  # within reach: clean documents keep some doubt about them
    rows = mixing.mixing_report(docs, labels, weights).collect()
    assert len(rows) == 400
    held = [r for r in rows if r.doc_id >= 300]
    right = sum(max(("p_clean", "p_low", "p_toxic"), key=lambda n: r[n]) == {0: "p_toxic", 1: "p_low"}.get(r.doc_id % 8, "p_clean") for r in held)
    assert right >= 0.95 * len(held)
    tokens = {d: sum(r.n_tokens * r.rate * r[f"p_{d}"] for r in rows) for d in mixing.DOMAINS}
    assert all(abs(tokens[d] / sum(tokens.values()) - w) < 0.01 for d, w in weights.items())
    mixed = mixing.mix(docs, labels, weights)
    assert mixed.columns == docs.columns
    want = collections.Counter({r.doc_id: r.copies for r in rows if r.copies})
    assert collections.Counter(r.doc_id for r in mixed.collect()) == want


def test_mixing_edges(odd, no_docs, labels, no_labels):
    for known in (labels, no_labels):
        rows = mixing.mixing_report(odd, known).collect()
        assert len(rows) == odd.count() and all(abs(r.p_clean + r.p_low + r.p_toxic - 1) < 1e-9 and r.rate >= 0 for r in rows)
    assert mixing.mixing_report(no_docs, labels).count() == 0 and mixing.mix(no_docs, labels).count() == 0
