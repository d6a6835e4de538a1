"""Aligned tokenizers and reused chunks against the libraries and plain loops."""

import hashlib
import random
from collections import Counter

import pytest
from llm_data import SCHEMA, documents, edited, empty, rows, sentence, texts

from shelfdiff.llm import alignment, chunk_reuse, tokens

pytest.importorskip("public_tokenizers")
import public_tokenizers  # noqa: E402

ODD = [
    "two  spaces and\n\nlines \n mixed", " leading", "trailing ", "\n", " ", "a\tb　c\xa0d\x1ce",
    "low ▁ bar", "<|endoftext|> <s> </s> <0x41> <unk>", "é ́x 'll don't 's", "x" * 3000, "a\x00b \x85 z",
    "中文 \U0001f642\U0001f642 ǅ Σας", "one\ntwo\nthree four", "1234 56,78.90 %$# ...", "﻿ start", "a\n b\r\nc",
]


def odd_texts():
    r = random.Random(7)
    letters = list("abc '.1\n ") + ["▁", "é", "中", " ", "\t", "<|", "|>"]
    return ODD + ["".join(r.choice(letters) for _ in range(r.randint(1, 40))) for _ in range(300)]


def table(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").repartition(3)


def plain_alignment(values):
    """Measures of each text by the definition, with the library of each tokenizer."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}

    def bytes_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(tokens):
        out, at = [], 0
        for i, data in tokens:
            out.append((i, at, at + len(data)))
            at += len(data)
        return out

    parsed = []
    for text in values:
        if not text:
            parsed.append(None)
            continue
        a = [(i, bytes(byte_of[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes_b(i)) for i in second.encode(text)]
        whole = (" " + text).encode()
        good = all(b"".join(x for _, x in side) == whole for side in (a, b))
        parsed.append((spans(a), spans(b)) if good else None)
    counts = Counter()
    linked = []
    for both in parsed:
        a, b = both or ([], [])
        pairs, k = [], 0
        for x, lo, hi in a:
            while k and b[k][1] > lo:
                k -= 1
            while k < len(b) and b[k][1] < hi:
                if b[k][2] > lo:
                    pairs.append((x, b[k][0]))
                k += 1
            k = min(k, len(b) - 1)
        linked.append(pairs)
        counts.update(set(pairs))
    best = Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for both, pairs in zip(parsed, linked, strict=True):
        if both is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b = both
        ends = sorted({x[2] for x in a} & {x[2] for x in b})
        groups = []
        for lo, hi in zip([0, *ends], ends, strict=False):
            sides = [",".join(str(i) for i, s, _ in side if lo <= s < hi) for side in (a, b)]
            groups.append("|".join(sides))
        n_best = sum(counts[p] == best[p[0]] for p in pairs)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((len(a), len(b), len(ends), len(pairs), n_best, sum(counts[p] for p in pairs), digest))
    return out


def test_alignment_equals_its_definition(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_CHARACTERS", 4000)
    base = texts(2, 30)
    values = [*odd_texts(), *base, *base[:10], base[0], None, ""]
    got = {x[0]: tuple(x[1:]) for x in alignment.align(table(spark, values)).collect()}
    assert got == dict(enumerate(plain_alignment(values)))


def test_alignment_of_awkward_rows(spark):
    found = alignment.align(documents(spark)).collect()
    assert sorted(map(str, (x.doc_id for x in found))) == sorted(str(x[0]) for x in rows())
    by_id = {x.doc_id: x for x in found}
    assert tuple(by_id[103])[1:] == tuple(by_id[104])[1:] == (0, 0, 0, 0, 0, 0, "")
    assert tuple(by_id[100])[1:] == tuple(by_id[0])[1:]
    assert alignment.align(empty(spark)).count() == 0


def test_units_survive_a_full_cache(monkeypatch):
    own = alignment.Aligner(*alignment.default_paths())
    monkeypatch.setattr(alignment, "CACHE_UNITS", 50)
    for text in texts(3, 20):
        places, starts = own.units([text, "a  b", text])
        assert starts[1] == starts[3] - starts[2]
        first, last = places[: starts[1]], places[starts[2] :]
        assert (own.links(first) == own.links(last)).all() and own.counts[first, 3].sum() == len(own.links(first))


def test_units_are_numbered_as_they_come():
    """Each is looked up once; odd units stand among usual ones, some are not given back."""
    import numpy as np

    own, alone = (alignment.Aligner(*alignment.default_paths()) for _ in range(2))
    values = [*odd_texts()[:80], *texts(3, 20), "é ́x"]
    places, starts = own.units(values)
    flat = [u for t in values for u in own.of.cut(t)[0]]
    assert list(own.places) == list(dict.fromkeys(flat))
    assert places.tolist() == [own.places[u] for u in flat]
    for text, lo, hi in zip(values, starts, starts[1:], strict=False):
        single, _ = alone.units([text])
        assert (own.counts[places[lo:hi]] == alone.counts[single]).all()
        assert own.links(places[lo:hi]).tolist() == alone.links(single).tolist()
        assert [own.groups[p] for p in places[lo:hi]] == [alone.groups[p] for p in single]
        assert own.whole(places[lo:hi]) == alone.whole(single)
    for some in ([], [3], [5, 2, 5, 2, 9]):
        assert alignment._distinct(np.array(some, np.int64)).tolist() == sorted(set(some))


def expected_ids(text):
    of = tokens.encoder(tokens.default_path()).tokenizer
    ids = of.encode(text or "", add_special_tokens=False).ids
    whole = of.decode(ids, skip_special_tokens=False)
    return len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), whole))


def copies():
    """Long texts that share passages at different places, and some that nothing shares."""
    r = random.Random(11)
    passages = [sentence(r, 400) for _ in range(6)]
    mixed = ["\n".join([sentence(r, r.randint(1, 300)), *r.sample(passages, 3), sentence(r, 50)]) for _ in range(25)]
    alone = [sentence(r, 900) for _ in range(5)]
    unbroken = ["ab" * 2000 + passages[0].replace(" ", ""), passages[0].replace(" ", "") + " " + passages[0]]
    special = [passages[0] + "<|endoftext|>" + passages[1], passages[0][:-7] + "́" + passages[1][5:]]
    return [*mixed, *alone, *unbroken, *special, edited(mixed[0], 1, 5), mixed[1], mixed[1], "中文" * 900, *odd_texts(), None, ""]


@pytest.mark.parametrize("bits", [chunk_reuse.MOST_BITS, 1 << 10])
def test_reused_chunks_give_the_ids_of_the_library(spark, bits, monkeypatch):
    """With a bitmap that is far too small as well: nearly all chunks look shared."""
    monkeypatch.setattr(chunk_reuse, "MOST_BITS", bits)
    values = copies()
    got = {x[0]: tuple(x[1:]) for x in chunk_reuse.encode_documents(table(spark, values)).collect()}
    assert got == {i: expected_ids(t) for i, t in enumerate(values)}


def test_chunks_follow_the_content():
    r = random.Random(5)
    passage = sentence(r, 1500)
    parts = [set(chunk_reuse.chunks(sentence(r, n) + passage + sentence(r, 60))) for n in (40, 333, 700)]
    size = sum(map(len, parts[0] & parts[1] & parts[2]))
    assert size > 0.6 * len(passage)
    for text in [*odd_texts(), passage]:
        assert "".join(chunk_reuse.chunks(text)) == text


def test_joins_widen_until_they_agree():
    """With an encoder to which a space is a part of what follows two words later."""

    def encode(text):
        return text.replace(" b ", " B ").encode()

    join = chunk_reuse.repaired("one two a b", " c three four", encode)
    assert join.ids == b" a B c" and (join.tail_size, join.head_size) == (4, 2)
    assert chunk_reuse.repaired("word", "word", encode) is None


def test_chunks_of_awkward_rows(spark):
    found = chunk_reuse.encode_documents(documents(spark)).collect()
    assert sorted(str(tuple(x)) for x in found) == sorted(str((r[0], *expected_ids(r[1]))) for r in rows())
    assert chunk_reuse.encode_documents(empty(spark)).count() == 0
    assert chunk_reuse.encode_documents(spark.createDataFrame([(1, None, *[None] * 11)], SCHEMA)).head()[1] == 0


def test_only_joins_with_shared_chunks_are_encoded_again():
    text = sentence(random.Random(13), 2000)
    parts = chunk_reuse.chunks(text)
    encoder = tokens.encoder(tokens.default_path())
    asked = []

    def encode(part):
        asked.append(part)
        return encoder.ids(part)

    assert len(parts) > 5
    assert chunk_reuse._pieces_of(text, encode, lambda found: [False] * len(found), True) == encoder.ids(text)
    assert asked == [text]
    asked.clear()
    pieces = chunk_reuse._pieces_of(text, encode, lambda found: [k == 2 for k in range(len(found))], True)
    assert ["ids" in p for p in pieces] == [True, False, True]
    assert {"".join(parts[:2]), "".join(parts[3:])} <= set(asked) and not {*parts} & {*asked}
    ids = chunk_reuse.trimmed(encoder.ids(parts[2]), pieces[1]["head"], pieces[1]["tail"]) + pieces[1]["joint"]
    assert pieces[0]["ids"] + ids + pieces[2]["ids"] == encoder.ids(text)


def test_decoded_texts_are_those_of_the_library(tmp_path):
    from tokenizers import Tokenizer, decoders

    plain = chunk_reuse._Digests(tokens.default_path())
    numbers = list(range(0, 49408, 7)) + [49406, 49407]
    assert plain.tokens is not None  # joined without the library
    other = Tokenizer.from_file(tokens.default_path())
    other.decoder = decoders.BPEDecoder(suffix="</w>")
    other.save(str(tmp_path / "other.json"))
    for digests in (plain, chunk_reuse._Digests(str(tmp_path / "other.json"))):
        for some in ([], numbers[:1], numbers):
            assert digests.decoded(some) == digests.tokenizer.decode(some, skip_special_tokens=False)
