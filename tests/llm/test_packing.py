import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clustertrace.llm.packing import ByteLevelIds, OpenWindows, pack
from clustertrace.llm.queries import packed
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(frame, library, size=1024, **options):
    """Every id lies in exactly one piece, offsets have no gaps, and only powers of two aren't full."""
    texts = defaultdict(list)
    for i, t in frame.select("doc_id", "text").collect():
        texts[i].append((library.encode(t or "", add_special_tokens=False).ids if t else []) + [0])
    rows = pack(frame, PATH, size=size, **options).collect()
    found, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] > 0
        found[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size and (at == size or at & (at - 1) == 0)
    assert set(found) == set(texts)
    for i, expected in texts.items():
        covered = sorted(x for start, ids, _ in found[i] for x in zip(range(start, start + len(ids)), ids, strict=True))
        assert covered == sorted((k, x) for ids in expected for k, x in enumerate(ids))
        assert {n for *_, n in found[i]} == {len(ids) for ids in expected}
    return rows


def test_odd_rows(odd, library):
    check(odd, library)


def test_small_windows_and_merges(odd, documents, library):
    check(odd, library, size=16, n_open=2, fan_in=2)
    check(documents.repartition(7), library, size=64, n_open=3, fan_in=3)


def test_documents(documents, library):
    rows = check(documents, library)
    pieces = packed(documents).collect()
    assert sorted(r["ids_crc32"] for r in pieces) == sorted(zlib.crc32(bytes(r["ids"])) for r in rows)
    assert len(rows) < 3 * documents.count()


def test_empty_table(none):
    assert pack(none, PATH).collect() == []


def test_best_fit_and_cut():
    windows = OpenWindows(10, 2, 0)
    assert list(windows.place(4)) == [(0, 4, 0, 0)]
    assert list(windows.place(7)) == [(0, 7, 1, 0)]
    assert list(windows.place(3)) == [(0, 3, 1, 7)]  # fits sequence 1 best, which is full now
    assert list(windows.place(8)) == [(0, 8, 2, 0)]
    # Nothing fits: the fullest window takes two ids, and the rest fits the other one.
    assert list(windows.place(7)) == [(0, 2, 2, 8), (2, 5, 0, 4)]
    assert list(windows.place(25)) == [(0, 10, 3, 0), (10, 10, 4, 0), (20, 5, 5, 0)]


def test_ids_equal_the_library(library):
    encoder = ByteLevelIds(PATH, remember=3)
    texts = ["", " ", "  a  b ", "it's we'll I'D", "\n\n a\tb \n", "x<|endoftext|> y", "Éa ß日本 ½ 12", "a\x1cb \x85c  d", "!!! ,word, w.w"]
    texts += [t for _, t, *_ in ODD if t]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
