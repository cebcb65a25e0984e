import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulsetrail.llm.queries import all_queries, tokenizer_path
from pulsetrail.llm.token_store import TokenReader, WordEncoder, read_tokens, write_tokens

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def coder():
    return WordEncoder(tokenizer_path())


TEXT = st.lists(
    st.sampled_from(["a", "The", " ", "  ", "\n", "\t", "'s", "é", "12", "!", "\x1c", "\x85", "　", "<|endoftext|>", "\r\n", "日本", "​", "’"])
).map("".join)


@settings(max_examples=500, deadline=None)
@given(TEXT | st.text())
def test_pieces_give_the_ids_of_the_whole(tokenizer, coder, text):
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    ids = np.frombuffer(coder.encode(pa.array([text]))[0], "<u2").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def expected(rows, tokenizer):
    start, out = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = [tuple(r) for r in all_queries()["op4_token_store"](spark, SF).collect()]
    assert sorted(found) == expected(rows, tokenizer)


def test_odd_rows(spark, documents, tokenizer):
    rows = [(5, None), (3, ""), (9, "one two " * 5000), (7, " \n x"), (None, "no id"), (8, "tail \n ")]
    found = [tuple(r) for r in all_queries()["op4_token_store"](spark, documents(rows)).collect()]
    assert sorted(found, key=lambda r: r[1]) == expected(rows, tokenizer)


def test_empty_table(spark, documents):
    assert all_queries()["op4_token_store"](spark, documents([])).count() == 0


def test_repeated_rows(spark, documents):
    found = all_queries()["op4_token_store"](spark, documents([(1, "a b")] * 3)).orderBy("start").collect()
    assert [(r.doc_id, r.start) for r in found] == [(1, 0), (1, 3), (1, 6)]


def test_single_document_and_dictionary(spark, tokenizer):
    df = spark.read.parquet(f"{SF}/documents.parquet").withColumnsRenamed({"lang": "id", "source": "path"})
    store = write_tokens(df, tokenizer_path())
    assert store.dictionary
    text = df.filter("doc_id = 7").first().text
    for file in store.manifest.collect():
        reader = TokenReader(file.path, store.dictionary)
        for row in reader.find(7):
            assert reader.ids(row).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
            break
    with pytest.raises(ValueError):
        TokenReader(store.manifest.first().path, b"other")
    whole = {r.doc_id: r.ids for r in read_tokens(spark, store).collect()}
    assert whole[7] == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
