import json
import random
from collections import defaultdict
from pathlib import Path
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import packing
from strata.llm.packing import LibraryIds, Packer, Piece, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")
KNOWN = Tokenizer.from_file(PATH)
KNOWN.encode_special_tokens = True


def ids(text):
    return [*KNOWN.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, want, size):
    """Every id in one piece, sequences gapless, padding nowhere. `want` lists the ids of each document."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length > 0 and len(r.ids) == 4 * r.length
        pieces[r.id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == size or (at < size and at & (at - 1) == 0)
    short = [s for s in sequences.values() if sum(r.length for r in s) < size]
    assert len(short) <= size.bit_length()
    known = defaultdict(list)
    for owner, tokens in want:
        known[owner, len(tokens)].append(tokens)
    assert set(pieces) == set(known)
    for key, parts in pieces.items():
        said = defaultdict(int)  # equal documents are told apart only by what their pieces hold
        for r in parts:
            for k, token in enumerate(np.frombuffer(r.ids, "<u4").tolist()):
                said[r.start + k, token] += 1
        heard = defaultdict(int)
        for tokens in known[key]:
            for k, token in enumerate(tokens):
                heard[k, token] += 1
        assert said == heard


def test_windows_hold_what_fits_best():
    full = []
    packer = Packer(8, 2, full.append)
    load = lambda name, n: [Piece(name, 0, np.arange(n, dtype=np.uint32), n)]
    for name, n in (("a", 5), ("b", 6), ("c", 2), ("d", 3)):
        packer.place(load(name, n))
    assert [[p.owner for p in w] for w in full] == [["b", "c"], ["a", "d"]]  # c: least room that holds it
    packer.place(load("e", 20))
    assert [[p.owner for p in w] for w in full[2:]] == [["e"], ["e"]]
    packer.place(load("f", 5))
    packer.place(load("g", 6))  # none holds it: the fullest takes its head
    assert [[(p.owner, p.start, len(p.ids)) for p in w] for w in full[4:]] == [[("f", 0, 5), ("g", 0, 3)]]
    assert [[p.owner for p in w] for w in packer.windows.values()] == [["e", "g"]]
    packer.close()
    sizes = [sum(len(p.ids) for p in w) for w in full]
    assert sum(sizes) == 5 + 6 + 2 + 3 + 20 + 5 + 6 and all(s == 8 or s & (s - 1) == 0 for s in sizes)


def test_documents(spark, docs):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(("lorem", "Ipsum", "dolor's", "42", "é")) for _ in range(rnd.randint(0, 300)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "same"), (502, "same"), (None, "x y"), (503, "long word " * 30_000), (504, "<|endoftext|>")]
    out = pack(docs(rows), LibraryIds(PATH, 0))
    assert out.columns == ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    check(out.collect(), [(i, ids(t)) for i, t in rows], 1024)
    assert pack(docs([]), LibraryIds(PATH, 0)).count() == 0
    check(pack(docs([(1, None)]), LibraryIds(PATH, 0)).collect(), [(1, [0])], 1024)


def test_many_partitions_are_merged_in_rounds(spark, docs, monkeypatch):
    rnd = random.Random(2)
    rows = [(i, "word " * rnd.randint(0, 60)) for i in range(400)]
    many = docs(rows).repartition(70)
    out = pack(many, LibraryIds(PATH, 0), size=64, limit=3).collect()
    check(out, [(i, ids(t)) for i, t in rows], 64)
    with pytest.raises(ValueError):
        pack(many, LibraryIds(PATH, 0), size=100)


def test_the_ids_are_those_of_the_library(monkeypatch):
    rnd = random.Random(3)
    encode = LibraryIds(PATH, 0)()
    some = ("a", "b'll", " ", "  ", "\n", "\t", "\r\n", "7", "é", "\xa0", "\x85", "\u2003", "　", "!", "<|endoftext|>", "\x1c", "\x1f",
            "\u200b", "\u180e", "\u1680", "\u2028", "語", "🙂", "'", "\x0b", "\x0c", "\ufeff", "\x00", "x" * 100)
    for _ in range(1500):
        text = "".join(rnd.choice(some) for _ in range(rnd.randint(0, 60)))
        assert encode([text])[0].tolist() == ids(text), repr(text)
    for text in ("a" * 5000, " " * 3000 + "x", "ab" * 4000, "é" * 900, "".join(rnd.choice("aeinrst") for _ in range(30_000))):
        assert encode([text])[0].tolist() == ids(text)
    monkeypatch.setattr(packing, "file_ranks", lambda path: None)  # a file that says more than ranks
    assert LibraryIds(PATH, 0)()(["it's <|endoftext|> so"])[0].tolist() == ids("it's <|endoftext|> so")


def test_ranks_of_a_file(tmp_path):
    import base64

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        assert packing.file_ranks(PATH) == {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    spec = json.loads(Path(PATH).read_text())
    spec["model"]["merges"][:2] = spec["model"]["merges"][1::-1]
    (tmp_path / "other.json").write_text(json.dumps(spec))
    assert packing.file_ranks(str(tmp_path / "other.json")) is None


SHARED = LibraryIds(PATH, 0)()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(texts):
    assert [found.tolist() for found in SHARED(texts)] == [ids(text) for text in texts]


def test_query(spark):
    from strata.llm.common import read
    from strata.llm.queries import op11_packing

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: ids(r.text) for r in read(spark, sf, "documents").collect()}
    total = 0
    for r in op11_packing(spark, sf).collect():
        part = texts[r.doc_id][r.start:r.start + r.length]
        assert r.doc_tokens == len(texts[r.doc_id]) and crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        total += r.length
    assert total == sum(map(len, texts.values()))
