import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import awkward_rows, prose
from skyledger.llm.token_files import TokenFile, TokenFileWriter, pack_bits, token_file_digests, unpack_bits, write_token_files
from skyledger.llm.tokens import Encoder, tokenizer_path

NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


UNTOUCHED = {name: Tokenizer.from_file(tokenizer_path(name)) for name in NAMES}


def whole_ids(name, text):
    """By a tokenizer of its own, just read from the file."""
    return UNTOUCHED[name].encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=300, deadline=None)
@given(parts=st.lists(st.sampled_from([*"abZé '  \n\t\r.,!9|<>*ßΣİ ́　\x1c\x01", "<|endoftext|>", "<|startoftext|>", "the ", "don't", "été", "ΣΑΣ", "²", "Ⅷ", "e\u0301", "日本", "\n", "\n", "\nIn ", "ǅ"]), max_size=60))
def test_cut_texts_encode_like_whole_ones(name, parts):
    text = "".join(parts)
    encode = Encoder.of(tokenizer_path(name))
    assert np.frombuffer(encode([text, None])[0], "<u4").tolist() == whole_ids(name, text)


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("word", ["İ", "aİ", "İa", "²", "ß"])
def test_marks_after_letters_of_more_than_one_sign(name, word):
    """A dotted capital I in lower case ends with a mark, which goes together with punctuation after it."""
    encode = Encoder(tokenizer_path(name))
    for text in [f"{word}.", f"x {word}...", f"x\n{word}*,", f"{word} {word}. {word}", f"{word}!\n{word}"] * 2:
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == whole_ids(name, text)


@pytest.mark.parametrize("name", NAMES)
def test_control_tokens(name):
    """Spelt out in a text they are the control tokens' ids, wherever they stand."""
    for text in ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "<|ENDOFTEXT|> x", "<|startoftext|>\n\nx y"]:
        ids = np.frombuffer(Encoder.of(tokenizer_path(name))([text])[0], "<u4").tolist()
        assert ids == whole_ids(name, text)
    assert max(whole_ids(name, "<|endoftext|>")) in (49407, 50256)


@pytest.mark.parametrize("name", NAMES)
def test_forgetting(name, monkeypatch):
    """Texts encode alike while generations come and go, and words met again stay."""
    monkeypatch.setattr("skyledger.llm.tokens.REMEMBERED", 20)
    encode = Encoder(tokenizer_path(name))
    for i in range(60):
        text = f"the same words, wörter {prose(i, 30)}"
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == whole_ids(name, text)
        assert len(encode.words) < 80 and len(encode.older) < 80 and len(encode.others) < 20
    assert "same" in encode.words | encode.older


@pytest.mark.parametrize("name", NAMES)
def test_real_texts_encode_like_whole_ones(name):
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    found = Encoder(tokenizer_path(name))(texts)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == (whole_ids(name, text) if text else [])


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_bits_round_trip(width, values):
    ids = np.array(values, dtype="<u4") >> np.uint32(32 - width)
    data = pack_bits(ids, width)
    assert len(data) == (len(ids) * width + 7) // 8
    assert unpack_bits(data, len(ids), width).tolist() == ids.tolist()


@pytest.mark.parametrize("block", [7, 64, 65536])
def test_file_reads_any_range(tmp_path, monkeypatch, block):
    monkeypatch.setattr("skyledger.llm.token_files.BLOCK", block)
    random = np.random.default_rng(block)
    docs = [random.integers(0, 49_408, n).astype("<u4") for n in (3, 0, 500, 1, 64, 128, 9)]
    writer = TokenFileWriter(f"{tmp_path}/x.bin", 16)
    for i, ids in enumerate(docs):
        writer.add(None if i == 1 else 100 + i, ids)
    writer.close()
    file = TokenFile(f"file:{tmp_path}/x.bin")
    whole = np.concatenate(docs)
    assert [ids.tolist() for _, ids in file.documents(50)] == [d.tolist() for d in docs]
    assert file.nulls.tolist() == [i == 1 for i in range(7)]
    for _ in range(200):
        a, b = sorted(random.integers(0, len(whole) + 1, 2))
        assert file.read(int(a), int(b)).tolist() == whole[a:b].tolist()


def test_cut_off_file_is_refused(tmp_path):
    (tmp_path / "x.bin").write_bytes(b"SKYTOK1\n" + bytes(100))
    with pytest.raises(ValueError, match="not a whole token file"):
        TokenFile(f"{tmp_path}/x.bin")


def expected(rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array([*(whole_ids(NAMES[0], text) if text else []), 1], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_awkward(spark, awkward):
    found = [tuple(r) for r in token_file_digests(spark, awkward.repartition(5)).collect()]
    assert Counter(found) == Counter(expected([r[:2] for r in awkward_rows()]))


def test_many_files(spark, some_prose, tmp_path):
    manifest = write_token_files(some_prose.repartition(7), f"file://{tmp_path}/out", tokenizer_path(NAMES[0]))
    assert sum(r.n_docs for r in manifest.collect()) == 120
    found = sorted(tuple(r) for r in token_file_digests(spark, some_prose).collect())
    assert found == expected([(r.doc_id, r.text) for r in some_prose.collect()])


def test_one_id_for_all(spark):
    """Rows without an id, and rows that share one, are dealt out and still in order of their texts."""
    rows = [(None if i % 2 else 7, prose(i % 90, 20)) for i in range(600)] + [(None, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert Counter(tuple(r) for r in token_file_digests(spark, docs).collect()) == Counter(expected(rows))


def test_ids_are_whole_numbers(spark, tmp_path):
    docs = spark.createDataFrame([("12", "a"), ("x1", "b")], "doc_id string, text string")
    write_token_files(docs.where("doc_id = '12'"), f"file://{tmp_path}/a", tokenizer_path(NAMES[0]))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        write_token_files(docs, f"file://{tmp_path}/b", tokenizer_path(NAMES[0]))


def test_nothing(spark, nothing):
    assert token_file_digests(spark, nothing).collect() == []
