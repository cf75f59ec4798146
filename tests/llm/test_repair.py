"""Re-Pair goes on until no pair is frequent."""

from collections import Counter

import numpy as np
import pytest

from lavoura.llm import token_files
from lavoura.llm.token_files import LEAST, SYMBOLS, Shard, compress


def most_frequent(body, places):
    """Occurrences of the most frequent pair that do not overlap, pairs across documents left out."""
    counts, ends = Counter(), [*places[1:].tolist(), len(body)]
    for a, b in zip(places.tolist(), ends, strict=True):
        last = {}
        for i in range(a, b - 1):
            pair = (int(body[i]), int(body[i + 1]))
            if last.get(pair, -2) < i - 1:
                counts[pair] += 1
                last[pair] = i
    return max(counts.values(), default=0)


def cases():
    rng = np.random.default_rng(4)
    words = [rng.integers(0, 300, int(rng.integers(1, 9))) for _ in range(400)]
    prose = np.concatenate([words[min(int(rng.zipf(1.3)), 400) - 1] for _ in range(20_000)])
    runs = np.concatenate([np.full(int(rng.integers(1, 200)), int(rng.integers(0, 3))) for _ in range(60)])
    return {"prose": prose, "runs": runs, "one run": np.full(5001, 7), "few": np.arange(20), "mixed": np.concatenate((prose[:5000], runs, prose[:5000]))}


@pytest.mark.parametrize("name", list(cases()))
def test_no_frequent_pair_is_left(name):
    ids = cases()[name].astype(np.uint32)
    cuts = np.array([0, len(ids) // 3, len(ids) // 2])
    alphabet, rules, lengths, body, places = compress(ids, cuts)
    assert len(alphabet) + len(rules) < SYMBOLS
    assert most_frequent(body, places) < LEAST
    shard = Shard(alphabet.astype("<u4").tobytes(), rules.astype("<u2").tobytes(), lengths.astype("<u4").tobytes(), body.astype("<u2").tobytes(), places.tolist())
    got, before = shard.all_ids()
    assert (got == ids).all() and before.tolist() == cuts.tolist()


def test_more_symbols_than_16_bits_hold(monkeypatch):
    """Rounds go on with wider pairs until no pair is frequent; the ids come back."""
    monkeypatch.setattr(token_files, "SYMBOLS", 500)
    rng = np.random.default_rng(3)
    words = rng.integers(0, 400, (900, 3))
    ids = words[rng.integers(0, 900, 30_000)].ravel().astype(np.uint32)
    cuts = np.arange(0, len(ids), 1000)
    present, rules, lengths, body, starts = token_files.compress(ids, cuts)
    assert len(present) + len(rules) > 500
    flat, start, length = token_files.expansions(len(present), rules.astype(np.int64), lengths)
    assert np.array_equal(present[flat[token_files._runs(start[body], length[body])]], ids)
    assert most_frequent(body, starts) < LEAST


def words_path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_words_share_their_letters():
    """Words that differ by marks alone are held once by their letters, not word by word."""
    rng = np.random.default_rng(5)
    letters = ["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(200)]
    marks = [a + b for a in ".,;:!?)" for b in ".,;:!?)-"] + ["."]
    encoder = token_files.Encoder(words_path())
    texts = [" ".join(x + m for x in letters).encode() for m in marks]
    found = encoder.encode(texts)
    assert len(encoder) <= len(letters) + len(marks) + 1
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == encoder.tokenizer.encode(text.decode(), add_special_tokens=False).ids


def test_odd_words_have_the_tokenizers_ids(monkeypatch):
    """Letters beyond ASCII, marks, special tokens, blanks of all kinds, also when the cache is emptied all the time."""
    encoder = token_files.Encoder(words_path())
    special = next(iter(encoder.tokenizer.get_added_tokens_decoder().values()), None)
    texts = [
        "", " ", "  a  b ", "\n\n", "ÀÉ Straße façade naïve, ÿ÷ß×", "it's they'll 'S", "é ä.", "x<y <b> a<", "日本 語。 ok", "1234 a1b2", "tab\there\r\nnbsp x",
        "ABC Def-ghi (jk) [l] {m} ~n~ o|p \\q `r` _s_", "İstanbul ſ K", "\x00 a\x00b", "a" * 3000, f"pre{special} {special}post {special}" if special else "x", "<|x|> <| y |>", "  a b \u0085",
    ]
    want = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in encoder.encode([t.encode() for t in texts])] == want
    monkeypatch.setattr(token_files, "CACHE_PARTS", 2)
    assert [x.tolist() for x in encoder.encode([t.encode() for t in texts])] == want
    assert [encoder.encode([t.encode()])[0].tolist() for t in texts] == want
    assert encoder.encode([]) == []
