"""Importance resampling and spelling variants against plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest

from touchline.llm import importance, spelling


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- importance -----------------------------------------------------------------------------------


def feature_buckets(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered(text))
    features = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(f.encode()) % 10_000 for f in features]


def resampled(docs, target, percent=25, least=20):
    """Rows of (doc_id, n_features, weight, score, rank) by the formula."""
    hashed = [(doc_id, *feature_buckets(text)) for doc_id, text in docs]
    s = collections.Counter(b for _, _, bs in hashed for b in bs)
    t = collections.Counter(b for text in target for b in feature_buckets(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000))))
    out = []
    for doc_id, n_words, bs in hashed:
        weight = sum(map(gain, bs)) // len(bs) if bs else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((n_words < least, -score, doc_id is not None, doc_id or 0, len(bs), weight, score))
    out.sort()
    drawn = percent * sum(not row[0] for row in out) // 100
    return [(row[2], row[3], row[4], row[5], row[6], i + 1 if i < drawn else None) for i, row in enumerate(out)]


@pytest.mark.parametrize("share", [importance.HEAD_SHARE, 1.0, 0.02])
def test_resampling_equals_the_formula(odd, no_docs, make, share, monkeypatch):
    """Whatever the head holds: everything that occurs, nothing, or a part."""
    monkeypatch.setattr(importance, "HEAD_SHARE", share)
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    target = ["alpha beta gammas deltaing. alpha", None, "Öl naïve"]
    for wanted in (target, []):
        rows = importance.resample(odd.repartition(4), make(wanted)).collect()
        got = sorted(((r[0] is not None, r[0] or 0, r[1], r[2], r[3], r[4]) for r in rows), key=repr)
        assert got == sorted(resampled(docs, wanted), key=repr)
    assert importance.resample(no_docs, make(target)).count() == 0


def test_head_finds_what_is_frequent(make, monkeypatch):
    monkeypatch.setattr(importance, "BLOCK_WORDS", 64)
    rnd = random.Random(3)
    texts = [" ".join(rnd.choices(["the", "of", "a"], [60, 30, 10], k=50)) + f" w{i}" for i in range(40)]
    head = importance.find_head(make(texts).repartition(3), 0.02, 10_000)
    assert head.words == [b"a", b"of", b"the"] and head.states.tolist() == [zlib.crc32(w) for w in head.words]
    pairs = [(head.words[k // 3], head.words[k % 3]) for k in head.pair_keys.tolist()]
    assert {(b"the", b"the"), (b"the", b"of"), (b"of", b"the"), (b"of", b"of")} <= set(pairs)
    assert head.pair_buckets.tolist() == [zlib.crc32(a + b" " + b) % 10_000 for a, b in pairs]


def test_hasher_forgets_its_memo(monkeypatch):
    monkeypatch.setattr(importance, "MEMO_WORDS", 2)
    hasher = importance.Hasher(importance.Head(), 10_000)
    for text in ("one two three four", "five six", "one two"):
        found, counts = hasher.buckets([importance.split_words(text)])
        assert found.tolist() == feature_buckets(text)[1] and counts.tolist() == [len(found)]


# --- spelling -------------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(docs):
    counts = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 7
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def test_variants_equal_brute_force(make, odd, no_docs):
    rnd = random.Random(11)
    stems = ["internation", "separate", "definite", "çaractèrè", "ÿÿÿÿÿÿÿ", "aaaaaaaa", "aaaaaaab", "abcdefg"]
    words = []
    for stem in stems:
        words += [stem] * 150
        for _ in range(30):
            i, w = rnd.randrange(len(stem)), list(stem)
            w[i : i + rnd.choice([0, 1])] = rnd.choice(["", rnd.choice("abeçÿz")])
            words += ["".join(w)] * rnd.choice([1, 2, 2, 12])
    rnd.shuffle(words)
    texts = [" ".join(w.upper() if rnd.random() < 0.1 else w for w in words[i : i + 40]) for i in range(0, len(words), 40)]
    for docs in (make([*texts, None, "", (None, texts[0]), (3, texts[1])]), odd):
        got = spelling.variant_groups(docs.repartition(4)).collect()
        want = variants([tuple(r) for r in docs.select("doc_id", "text").collect()])
        assert set(map(tuple, got)) == want and len(got) == len(want)
    assert any(r.form for r in spelling.variant_groups(make(texts)).collect())
    assert spelling.variant_groups(no_docs).count() == 0


@pytest.mark.parametrize("least_chars", [3, 4, 9])
def test_near_pairs_at_other_lengths(spark, least_chars):
    rnd = random.Random(least_chars)
    words = sorted({"".join(rnd.choices("abcxé", k=rnd.randint(least_chars, least_chars + 3))) for _ in range(400)})
    table = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "word string, n long")
    got = sorted((r.word, r.near) for r in spelling.near_pairs(table, least_chars).collect())
    assert got == sorted((a, b) for a in words for b in words if one_edit(a, b))


def test_chains_of_forms_reach_their_root(make):
    """Each word of a chain is ten times as frequent as the one before."""
    chain = [("abcdefghi", 2), ("abcdefgh", 20), ("abcdefgx", 200), ("abcdefyx", 2000)]
    docs = make([(i, " ".join([w] * n)) for i, (w, n) in enumerate(chain)])
    roots = {r.word: r.root for r in spelling.variant_groups(docs, every=0).collect()}
    assert roots == {w: "abcdefyx" for w, _ in chain}
