from __future__ import annotations

import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

from loomstream.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def library(texts):
    t = Tokenizer.from_file(PATH)
    return [(e.ids, t.decode(e.ids, skip_special_tokens=False)) for e in t.encode_batch(texts, add_special_tokens=False)]


def test_ids_and_decoded_text_equal_the_library(spark, sf_dir):
    rng = random.Random(4)
    pool = [chr(c) for c in [*range(0x250), 0x3A3, 0x3C3, 0x130, 0x301, 0x2028, 0x85, 0xA0, 0x4E2D, 0x1F600, 0xBD, 0x2167, 0xFB01, 0x1E9E, 0x212A, 0xAC00, 0x1100, 0x10400]]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["", "<|endoftext|>a<|startoftext|> b<|endoftext|", "It's they're I'LL", "a" * 5000, "ab" * 20_000, "ΑΣ ΟΔΟΣ", "word " * 3000]
    df = spark.createDataFrame([*enumerate(texts), (None, None), (0, texts[0])], "doc_id long, text string")
    got = sorted(((r.doc_id, list(r.ids), r.decoded) for r in bpe.encoded(df).collect()), key=str)
    want = sorted([(i, *x) for i, x in enumerate(library(texts))] + [(None, [], ""), (0, *library(texts[:1])[0])], key=str)
    assert got == want
    digests = {r.doc_id: r.ids_sha256 for r in bpe.encoded_digests(df.limit(500)).collect()}
    assert all(digests[i] == hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest() for i, (x, _) in enumerate(library(texts[:400])))
    assert bpe.encoded_digests(df.limit(0)).count() == 0


def test_transducer_against_a_dictionary():
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(600)})
    ids = [[rng.randrange(9) for _ in range(rng.randint(1, 3))] for _ in words]
    lexicon = bpe.Lexicon(bpe.compile_lexicon(words, ids))
    place = dict(zip(words, ids, strict=True))
    asked = [*words, "", "zzz", "abcabcabc", *[w + "a" for w in words]]
    for w, n in zip(asked, lexicon.number(asked).tolist(), strict=True):
        assert (lexicon.ids[lexicon.starts[n] : lexicon.starts[n + 1]].tolist() == place[w]) if w in place else n == -1
    states = len({k // 256 for k in lexicon.keys.tolist()})
    assert states < len({w[:i] for w in words for i in range(len(w))})  # fewer than a trie without shared suffixes
    assert (bpe.Lexicon(bpe.compile_lexicon([], [])).number(["a"]) == -1).all()
