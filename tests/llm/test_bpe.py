import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clustertrace.llm.bpe import PairIndex, WordBPE, encode_decode
from clustertrace.llm.queries import op5_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(frame, library):
    expected = []
    for i, t in frame.select("doc_id", "text").collect():
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    got = [(r["doc_id"], np.frombuffer(bytes(r["ids"]), "<u4").tolist(), r["decoded"]) for r in encode_decode(frame, PATH).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_odd_rows(odd, library):
    check(odd, library)


def test_documents(spark, sf_dir, documents, library):
    check(documents, library)
    digests = {r["doc_id"]: tuple(r)[1:] for r in op5_bpe(spark, sf_dir).collect()}
    for i, t in documents.select("doc_id", "text").collect():
        ids = library.encode(t, add_special_tokens=False).ids
        raw = np.asarray(ids, "<u4").tobytes()
        text = library.decode(ids, skip_special_tokens=False).encode()
        assert digests[i] == (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text).hexdigest())


def test_empty_table(none):
    assert encode_decode(none, PATH).collect() == []


def test_random_texts(library):
    rnd = random.Random(1)
    alphabet = "aA é'sStT\n\t 12!<|>endoftxÉ日 ́ßΣİ\x1c\x85 "
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(2000)]
    encoder = WordBPE(PATH, remember=50)
    got = list(encoder.encode_all(texts, at_once=500))
    for text, (ids, decoded) in zip(texts, got, strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert decoded == library.decode(expected, skip_special_tokens=False)


def one_by_one(word, rules):
    word = list(word)
    while True:
        pairs = [(rules[p], k) for k, p in enumerate(zip(word, word[1:], strict=False)) if p in rules]
        if not pairs:
            return word
        rank = min(pairs)[0]
        out, k = [], 0
        while k < len(word):
            if k + 1 < len(word) and rules.get((word[k], word[k + 1])) == rank:
                out.append(100 + rank)
                k += 2
            else:
                out.append(word[k])
                k += 1
        word = out


def test_pair_index_merges_each_word_as_on_its_own():
    rnd = random.Random(2)
    for _ in range(200):
        rules = {}
        for rank in range(12):
            symbols = [0, 1, 2, *(100 + r for r in range(rank))]
            pair = (rnd.choice(symbols), rnd.choice(symbols))
            if pair not in rules:
                rules[pair] = rank
        pairs = sorted(rules, key=rules.get)
        table = np.array([[*p, 100 + rules[p]] for p in pairs])
        ranks = {p: k for k, p in enumerate(pairs)}
        index = PairIndex(table[:, 0], table[:, 1], table[:, 2], 200)
        words = [[rnd.randrange(3) for _ in range(rnd.randrange(1, 15))] for _ in range(20)]
        ids, counts = index.merge(np.array(sum(words, [])), np.array(list(map(len, words))))
        got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        made = {100 + rules[p]: 100 + ranks[p] for p in pairs}
        expected = [one_by_one(w, rules) for w in words]
        assert [[made.get(s, s) for s in w] for w in got] == [[made.get(s, s) for s in w] for w in expected]
