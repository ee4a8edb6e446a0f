"""Token files, token counts and sampled pieces against the libraries."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import piece_sampling, token_counts, token_files
from touchline.llm.common import tokenizer
from touchline.llm.elias_fano import EliasFano

WORDS, BYTES, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer(name))


@pytest.mark.parametrize("values", [[], [0], [5, 5, 5], [0, 1, 2, 1000], list(range(0, 40_000, 7)), [3] * 700 + [1 << 40]])
def test_elias_fano(values):
    sequence, after = EliasFano.from_bytes(b"xy" + EliasFano.of(values).to_bytes(), 2)
    assert after == 2 + len(EliasFano.of(values).to_bytes())
    assert sequence.all().tolist() == values and [sequence.select(i) for i in range(len(values))] == values


def test_elias_fano_random():
    rng = np.random.default_rng(1)
    for n in (1, 255, 256, 257, 3000):
        values = np.sort(rng.integers(0, 1 << int(rng.integers(1, 45)), n)).tolist()
        sequence = EliasFano.of(values)
        assert [sequence.select(i) for i in range(n)] == values
        assert len(sequence.to_bytes()) <= n * (2 + max(1, (values[-1] // n + 1).bit_length())) / 8 + n // 8 + 64


def fuzz(n, seed=2):
    rnd = random.Random(seed)
    letters = [chr(i) for i in (*range(0x250), 0x300, 0x301, 0x345, 0x3A3, 0x3C2, 0x1E9E, 0x2028, 0x3000, 0xFB01)] + [" ", "\n", "'", "e"] * 40
    return ["".join(rnd.choices(letters, k=60)) for _ in range(n)] + ["!!'re we've--'s' don't'll", "a<|endoftext|>b <|STARTOFTEXT|> <|startoftext|>"]


def test_chunk_encoder_equals_the_library():
    encoder, whole = token_files.ChunkEncoder(tokenizer(WORDS)), library(WORDS)
    for text in fuzz(300):
        assert np.frombuffer(encoder.encode([text])[0], "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_token_files(odd, odd_texts, no_docs):
    whole, start, want = library(WORDS), 0, []
    ordered = sorted(odd.select("doc_id", F.coalesce("text", F.lit(""))).collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for doc_id, text in ordered:
        ids = [*whole.encode(text, add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(map(tuple, token_files.token_report(odd, tokenizer(WORDS)).collect()), key=lambda r: r[1])
    assert got == want
    assert token_files.token_report(no_docs, tokenizer(WORDS)).count() == 0


def test_token_file_selects_one_document():
    parts = [np.arange(n, dtype="<u2").tobytes() for n in (3, 0, 700, 1)]
    f = token_files.TokenFile(token_files.pack_file([None, -5, 7, 7], parts))
    assert f.doc_ids() == [None, -5, 7, 7]
    assert [f.document(i).tobytes() for i in range(4)] == parts


def test_token_counts(odd, no_docs):
    whole = library(BYTES)
    texts = [r[0] for r in odd.select(F.coalesce("text", F.lit(""))).collect()]
    want = sorted((len(t.encode()), n := len(whole.encode(t, add_special_tokens=False).ids), n > 512) for t in texts)
    rows = token_counts.count_tokens(odd, tokenizer(BYTES), with_prefixes=True).collect()
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want
    assert all(r.unit_counts == [] or r.unit_counts[-1] == r.n_tokens for r in rows)
    assert token_counts.count_tokens(no_docs, tokenizer(BYTES)).count() == 0


def test_every_prefix_is_counted():
    counter, whole = token_counts.PrefixCounter(tokenizer(BYTES)), library(BYTES)
    for text in ["hello   world don't we'll x'll've   ", "naïve — “quoted” 12345 \n\n  tabs\t\tfoo", "日本語 テキスト  ok", "!!'re we've", *fuzz(40)[:-1]]:
        for unit in counter.unit_counts([text])[0][0]:
            want = [len(whole.encode(unit[:k], add_special_tokens=False).ids) for k in range(len(unit) + 1)]
            assert counter.unit_prefixes(unit) == want, unit


def test_units_add_up_to_the_library():
    counter, whole = token_counts.PrefixCounter(tokenizer(BYTES)), library(BYTES)
    for text in fuzz(300, 5):
        assert sum(counter.unit_counts([text])[0][1]) == len(whole.encode(text, add_special_tokens=False).ids)


def test_cut_is_the_longest_prefix():
    counter, whole = token_counts.PrefixCounter(tokenizer(BYTES)), library(BYTES)
    text = " ".join(fuzz(3)[:3])
    (units, counts), size = counter.unit_counts([text])[0], lambda k: len(whole.encode(text[:k], add_special_tokens=False).ids)
    for budget in (0, 1, 5, 17, 60):
        assert counter.cut(units, counts, budget) == max(k for k in range(len(text) + 1) if size(k) <= budget)


@pytest.fixture(scope="module")
def lattice():
    return piece_sampling.PieceLattice(tokenizer(PIECES))


def encode(lattice, texts, keys, seed=11):
    ids, bounds = lattice.encode(texts, np.array(keys), seed)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def test_pieces_are_lossless_and_reproducible(lattice, odd_texts):
    texts = [t if not isinstance(t, tuple) else t[1] for t in odd_texts] + fuzz(100)
    keys = list(range(len(texts)))
    ids = encode(lattice, texts, keys)
    assert all(lattice.decode(np.array(i)) == (t or "") for i, t in zip(ids, texts, strict=True))
    again = encode(piece_sampling.PieceLattice(tokenizer(PIECES)), texts[::-1], keys[::-1])[::-1]
    assert again == ids
    assert encode(lattice, texts, keys, 12) != ids


def test_samples_follow_the_path_weights(lattice):
    word, weight = " then", {p: w for p, (_, w) in lattice.pieces.items()}

    def paths(rest):
        if not rest:
            return [((), 1.0)]
        return [((rest[:k], *tail), weight[rest[:k]] * w) for k in range(1, len(rest) + 1) if rest[:k] in weight for tail, w in paths(rest[k:])]

    every = dict(paths(word))
    total, n, seen = sum(every.values()), 40_000, {}
    for ids in encode(lattice, [word[1:]] * n, range(n)):
        seen[tuple(ids)] = seen.get(tuple(ids), 0) + 1
    for path, w in every.items():
        p = w / total
        ids = tuple(lattice.pieces[x][0] for x in path)
        assert abs(seen.get(ids, 0) - n * p) < 5 * (n * p * (1 - p)) ** 0.5 + 2
    assert sum(seen.values()) == n


def test_alias_tables_keep_the_shares():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 9, 200)
    shares = np.concatenate([rng.dirichlet(np.full(n, 0.3)) for n in counts if n])
    threshold, alias = piece_sampling.alias_tables(shares, counts)
    owner, stays = np.repeat(np.arange(200), counts), (threshold + 1.0) * 2.0**-32
    assert (owner[alias] == owner).all()
    got = (stays + np.bincount(alias, 1.0 - stays, len(shares))) / counts[owner]
    assert np.allclose(got, shares, atol=1e-8)


def test_parts_hold_whole_pieces(lattice):
    """No piece of the model crosses a cut between parts."""
    for piece in lattice.pieces:
        assert lattice.part.findall(piece) == [piece]


def test_sampled_rows(odd, no_docs, lattice):
    rows = piece_sampling.sample_pieces(odd, tokenizer(PIECES)).collect()
    assert len(rows) == odd.count() and all(r.lossless for r in rows)
    assert sum(r.ids is None for r in rows) == 2 and all(r.n_ids == len(r.ids or []) for r in rows)
    decoded = piece_sampling.decode_pieces(piece_sampling.sample_pieces(odd, tokenizer(PIECES)), tokenizer(PIECES))
    assert sorted(map(str, decoded.collect())) == sorted(map(str, odd.select("doc_id", "text").collect()))
    assert piece_sampling.sample_pieces(no_docs, tokenizer(PIECES)).count() == 0
