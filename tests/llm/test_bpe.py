import hashlib
import random

import pytest
from tokenizers import Tokenizer

from riskpanel.llm import bpe
from tests.llm.tables import empty_documents, odd_documents, odd_rows, rows_of


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(bpe.default_path())
    out.no_truncation()
    out.no_padding()
    return out


@pytest.fixture(scope="module")
def encoder():
    with open(bpe.default_path(), encoding="utf-8") as f:
        return bpe.Encoder(f.read())


def texts_to_try(encoder):
    r = random.Random(1)
    plain = [t.replace(bpe.END, "") for t in encoder.tokens if t.isascii()]
    return ["", "  ", "Σίσυφος ΣΑΣ İstanbul ǅ", "it's I'M you'LL <|endoftext|> x<|startoftext|>y",
            "a\x1cb\x85c d​e", "é Å ﬁ ½ ² Ⅷ ٣", "日本語のテキスト 🙂🙂🏽 ❤️", "x" * 5000,
            "aaaaaaaa" * 300 + "'s", "ab" * 999,
            *("".join(r.choice("abcdefghijklmnopqrstuvwxyz'éß \n0123!?#")
                      for _ in range(r.randrange(60))) for _ in range(800)),
            *("".join(r.choice(plain) for _ in range(3)) for _ in range(2000))]


def test_equals_the_library(encoder, library):
    tried = texts_to_try(encoder)
    for text, (ids, decoded), want in zip(tried, encoder.encoded(tried), library.encode_batch(
            tried, add_special_tokens=False)):
        assert ids.decode() == " ".join(map(str, want.ids)), text
        assert decoded.decode() == library.decode(want.ids, skip_special_tokens=False)


def test_pairs_are_compatible_exactly_if_merging_keeps_them(encoder):
    import numpy as np

    r = random.Random(3)
    a = np.array([r.randrange(49_406) for _ in range(4000)])
    b = np.array([r.randrange(49_406) for _ in range(4000)])
    inner = np.array([not encoder.tokens[x].endswith(bpe.END) for x in a])
    a, b = a[inner], b[inner]
    want = [encoder.merged(encoder.symbols(x) + encoder.symbols(y)) == [x, y]
            for x, y in zip(a.tolist(), b.tolist())]
    assert encoder.compatible(a, b).tolist() == want


def test_some_words_need_merging(encoder):
    """Greedy cuts alone are not the encoding."""
    r = random.Random(5)
    words = {"".join(r.choice("abcdeéinst") for _ in range(9)) for _ in range(300)}
    spelled = {w: w.encode().decode("latin-1").translate(encoder.letters) + bpe.END for w in words}
    encoder.learn(words)
    cut = {w: encoder.proposed(s) for w, s in spelled.items()}
    assert any(" ".join(map(str, cut[w])).encode() != encoder._kept[w][0] for w in words)


def test_a_part_learns_its_words_at_once(encoder, monkeypatch):
    """One call for the new words of all texts, each word once."""
    learned = []
    plain = bpe.Encoder.learn
    monkeypatch.setattr(bpe.Encoder, "learn", lambda e, words: (learned.append(set(words)),
                                                                plain(e, words)))
    tried = [f"zqj{chr(97 + i % 26)}{chr(97 + i // 26)}x zqjyy" for i in range(40)]
    list(encoder.encoded(tried))
    assert [len(x) for x in learned] == [41]
    list(encoder.encoded(tried))
    assert len(learned) == 1


def test_kept_words_stay_few_and_right(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 60)
    tried = [t for t in texts_to_try(encoder) if t.strip()][:300]
    for i in range(0, len(tried), 10):
        part = tried[i:i + 10]
        for (ids, _), want in zip(encoder.encoded(part), library.encode_batch(
                part, add_special_tokens=False)):
            assert ids.decode() == " ".join(map(str, want.ids))
    words = {w for t in part for w in encoder.words(t)}
    assert len(encoder._kept) <= max(30, len(words))


def test_odd_rows(spark, library):
    want = []
    for row in odd_rows():
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        want.append((row[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode())
                     .hexdigest()))
    got = bpe.digests(odd_documents(spark)).collect()
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
                   for r in got), key=repr) == sorted(want, key=repr)


def test_encode_and_decode_keep_the_other_columns(spark, library):
    df = odd_documents(spark)
    out = bpe.decode(bpe.encode(df))
    assert out.columns == [*df.columns, "ids", "decoded"]
    for r in out.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_empty_table(spark):
    assert rows_of(bpe.digests(empty_documents(spark))) == []
