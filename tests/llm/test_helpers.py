"""The numpy helpers, piece by piece."""

import io
import random

import numpy as np
import pyarrow as pa
import pytest

from kestrel.llm import exact_search, language_id, near_dedup, packing, shingles, substring_dedup, suffix_array, token_records


def test_suffix_array_orders_all_suffixes():
    rng = random.Random(1)
    for _ in range(150):
        alphabet = rng.choice([b"ab", b"abc", bytes(range(256)), b"\x00\x01", b"a"])
        strings = [bytes(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(rng.randint(1, 8))]
        symbols = suffix_array.joined(strings)[0]
        listed = symbols.tolist()
        assert suffix_array.suffix_array(symbols, 1 << 20).tolist() == sorted(range(len(listed)), key=lambda i: listed[i:])
        depth = rng.randint(1, 6)
        some = suffix_array.suffix_array(symbols, depth).tolist()
        assert sorted(some) == list(range(len(listed)))
        assert all(listed[x:x + depth] <= listed[y:y + depth] for x, y in zip(some, some[1:]))


def test_common_prefixes():
    rng = random.Random(2)
    data = bytes(rng.choices(b"ab", k=600)) * 2
    a = np.asarray([rng.randrange(700) for _ in range(300)])
    b = np.asarray([(x + 600) % 700 if rng.random() < 0.5 else rng.randrange(700) for x in a])
    got = suffix_array.common_prefixes(np.frombuffer(data, np.uint8), a, b, 400)
    for x, y, n in zip(a, b, got):
        assert data[x:x + n] == data[y:y + n] and (n == 400 or data[x + n] != data[y + n])


def test_large_bucket_finds_pairs_across_blocks(monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 4000)
    rng = random.Random(3)
    strings = [bytes(rng.choices(b"abcdef", k=500)) for _ in range(20)]
    strings[17] = strings[2][:450] + b"z" + strings[17][451:]
    rows = [{"tid": bytes([k]), "p": 0, "q": 101, "at": 5, "anchor": 1, "salt": 0, "salts": 1, "bytes": s}
            for k, s in enumerate(strings)]
    marks = {(r["tid"][0], r["p"], r["q"]) for r in substring_dedup._large_bucket(rows) if r["kind"] == "mark"}
    assert marks == {(2, 0, 450), (17, 0, 450)}


def test_anchor_depends_on_the_window_alone():
    rng = random.Random(4)
    core = bytes(rng.choices(range(256), k=700))
    found = []
    for _ in range(2):
        data = np.frombuffer(bytes(rng.choices(range(256), k=rng.randint(0, 900))) + core + bytes(50), np.uint8)
        text, anchor, p, q, at = substring_dedup.anchor_runs(data, np.asarray([len(data)]))
        where = bytes(data).find(core)
        found.append({(x - where): (a, h - x) for a, s, e, h in zip(anchor, p, q, at) for x in range(s, e)
                      if where <= x <= where + 300})
    assert found[0] == found[1] and len(found[0]) == 301


def test_shingle_sets_do_not_depend_on_the_batch(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices("aB \n\té", k=rng.randint(0, 400))) for _ in range(60)] + ["x" * 3000, "", " "]
    whole = list(shingles.shingle_sets(pa.array(texts), 4))
    monkeypatch.setattr(shingles, "PIECE", 128)
    for a, b in zip(whole, shingles.shingle_sets(pa.array(texts), 4)):
        assert (a == b).all()
    assert [len(s) for s in shingles.shingle_sets(pa.array(["", " ", "a", "a b", "a b c d", "A B C D e"]), 4)] == [0, 0, 1, 1, 1, 2]


def test_estimate_is_close_to_jaccard():
    rng = np.random.default_rng(0)
    for share in (0.5, 0.8, 0.95):
        both = int(2000 * share)
        errors = []
        for _ in range(40):
            pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 4000).astype(np.uint64)
            x, y = np.unique(pool[:2000]), np.unique(np.concatenate([pool[:both], pool[2000:4000 - both]]))
            value, _ = near_dedup.estimate(near_dedup.registers_of(x), near_dedup.registers_of(y),
                                           np.float64(len(x)), np.float64(len(y)))
            errors.append(value - both / (4000 - both))
        assert abs(np.mean(errors)) < 0.03


def test_pack_never_overfills_and_beats_one_size():
    rng = np.random.default_rng(1)
    sizes = np.sort(rng.integers(1, 4097, 500))[::-1]
    bins, offsets, final = packing.pack(sizes)
    fill = np.bincount(bins, weights=sizes)
    assert (fill <= final).all()
    assert final.sum() < 1.1 * sizes.sum()


def test_records_detect_damage():
    payload = token_records.serialize(-7, np.asarray([1, 70000], np.uint32))
    doc_id, ids = token_records.deserialize(payload)
    assert doc_id == -7 and ids.tolist() == [1, 70000]
    assert token_records.deserialize(token_records.serialize(None, np.asarray([5], np.uint32)))[0] is None
    framed = bytearray(token_records.frame(payload))
    assert token_records.read_record(io.BytesIO(framed)) == payload
    for at in (0, 9, 20, len(framed) - 1):
        broken = bytearray(framed)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            token_records.read_record(io.BytesIO(broken))


def test_pieces_give_the_ids_of_whole_texts(monkeypatch):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(token_records.default_tokenizer())
    rng = random.Random(6)
    alphabet = ["a", "bc", "the", " ", " ", "  ", "\n", "\t", "é", "日", "1", "'s", ".", "\u00a0", "\x1c", "_", "<|endoftext|>", "\0"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 300))) for _ in range(200)] + ["", " ", " a", "a ", "a\nb", "a\n", "\na", "a\0b c"]
    plain = ["a", "bc", "the", "é", "1", "'s", ".", "_", "<|endoftext|>"]
    texts += ["".join(rng.choice([" ", "\n"]).join("".join(rng.choices(plain, k=3)) for _ in range(9))) for _ in range(100)]
    rng.shuffle(texts)
    monkeypatch.setattr(token_records, "CACHE_PIECES", 50)
    encoder = token_records.PieceEncoder(tokenizer)
    for at in range(0, len(texts), 7):
        part = texts[at:at + 7]
        for text, ids in zip(part, encoder.encode(pa.array(part))):
            assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_features_do_not_depend_on_the_piece(monkeypatch):
    text = "".join(random.Random(7).choices("abcdé ", k=5000)).encode()
    whole = language_id.features(text)
    monkeypatch.setattr(language_id, "PIECE", 64)
    assert np.allclose(whole, language_id.features(text))


def test_search_pair_reads_few_levels_and_large_numbers():
    rng = np.random.default_rng(2)
    for top in (200, 1 << 40):  # the second needs Python integers
        x, q = rng.integers(-top, top, (300, 8)), rng.integers(-top, top, (4, 8))
        if top > 1 << 30:
            x, q = x >> 11, q >> 11
        base = x.min(axis=0)
        above = (x - base).T.astype(np.uint64)
        levels = int(above.max()).bit_length()
        segments = [np.packbits((above >> np.uint64(p)) & np.uint64(1) != 0, axis=1).tobytes() for p in range(levels - 1, -1, -1)]
        found = exact_search.search_pair(np.arange(4) + 1000, q, np.arange(300), base, segments, 5)
        scores = q @ x.T
        want = [(1000 + i, j, int(scores[i, j])) for i in range(4)
                for j in sorted(range(300), key=lambda j: (-scores[i, j], j))[:5]]
        assert list(zip(*(f.tolist() for f in found))) == want
