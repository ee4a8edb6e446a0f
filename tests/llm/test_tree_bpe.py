"""BPE by tree concatenation against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest

from touchline.llm import tree_bpe
from touchline.llm.common import tokenizer

BYTES = "byte_bpe_50k.json"


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer(BYTES))


def odd_strings(n, seed):
    rnd = random.Random(seed)
    alphabets = [
        ["a"], ["a", "b"], ["'", "s", "re", "ll", " ", "  ", "\n", "!", "é", "日本", "the", "<|endoftext|>", "<|endof", "12"],
        [*map(chr, range(32, 0x250)), *" " * 40, "　", "\x85", "\x1c", "​", "🙂"],
        ["the", "inter", "nation", "al", "izat", "ion", "un", "ing", "ed"], ["don't ", "we've ", "running ", "x"], [*"0123456789=-_+/"],
    ]
    return ["".join(rnd.choices(rnd.choice(alphabets), k=rnd.randint(1, 300))) for _ in range(n)]


@pytest.mark.parametrize("segment", [1, 2, 7, 50])
def test_joins_at_any_cut_equal_the_library(segment):
    encoder, whole = tree_bpe.TreeEncoder(tokenizer(BYTES)), library()
    for text in odd_strings(400, segment):
        parts = [text]
        while max(map(len, parts)) > segment:
            parts = [x for p in parts for x in (p[: len(p) // 2], p[len(p) // 2 :])]
        want = whole.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text).tolist() == want
        assert encoder.join_all([encoder.encode(p) for p in parts]).tolist() == want
        assert encoder.decode(np.array(want, np.int32)) == whole.decode(want, skip_special_tokens=False)


def test_every_character_falls_into_the_same_class():
    encoder, whole = tree_bpe.TreeEncoder(tokenizer(BYTES)), library()
    for start in range(0, 0x110000, 0x400):
        text = "".join(f"a{chr(c)}1 {chr(c)}b {chr(c)}!" for c in range(start, start + 0x400) if not 0xD800 <= c < 0xE000)
        assert encoder.encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids, hex(start)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    whole, out = library(), []
    for doc_id, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids
        decoded = whole.decode(ids, skip_special_tokens=False)
        out.append((doc_id is not None, doc_id or 0, len(ids), digest(",".join(map(str, ids))), digest(decoded)))
    return sorted(out)


def test_report_on_odd_documents(odd, no_docs):
    got = tree_bpe.tree_report(odd, tokenizer(BYTES)).collect()
    assert sorted((r[0] is not None, r[0] or 0, *r[1:]) for r in got) == expected(odd.select("doc_id", "text").collect())
    assert tree_bpe.tree_report(no_docs, tokenizer(BYTES)).count() == 0


def test_distributed_cuts(make):
    """Every text above 40 code points takes the tree, copies and repeated ids included."""
    texts = [*odd_strings(60, 9), "y" * 4000, "long words " * 500]
    docs = make([*texts, *texts[:5], (3, texts[7]), (None, texts[7])]).repartition(3)
    got = {(r[0], tuple(r[1])) for r in tree_bpe.encode(docs, tokenizer(BYTES), segment=40).collect()}
    whole = library()
    want = {(d, tuple(whole.encode(t, add_special_tokens=False).ids)) for d, t in docs.select("doc_id", "text").collect()}
    assert got == want
    assert tree_bpe.encode(docs, tokenizer(BYTES), segment=40).count() == docs.count()


def test_only_tokenizers_of_its_kind():
    with pytest.raises(ValueError):
        tree_bpe.TreeEncoder(tokenizer("word_bpe_49k.json"))
