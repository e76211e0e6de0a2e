import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ferry.llm import token_blocks as B
from ferry.llm.files import locate
from ferry.llm.queries import tokenizer_file
from ferry.llm.tokenizing import encoder
from tests.llm.helpers import DOCS, odd_docs


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 1000, B.BLOCK])
@pytest.mark.parametrize("top", [0, 1, 255, 256, 50_000, 2**32 - 1])
def test_blocks_round_trip(n, top):
    rng = np.random.default_rng(n + top)
    values = rng.integers(0, top + 1, n, dtype=np.uint64).astype(np.uint32)
    for v in (values, np.where(rng.random(n) < 0.05, values, values % 17).astype(np.uint32), values | np.uint32(1 << 20)):
        data = B.pack_block(v)
        got, end = B.unpack_block(b"x" + data, 1)
        assert end == len(data) + 1 and np.array_equal(got, v)


def test_outliers_do_not_widen_a_block():
    v = np.arange(1000, dtype=np.uint32) % 16 + 700
    v[::50] = 2**31
    assert len(B.pack_block(v)) < 1000 * 4 / 8 + 20 * 6 + 40


def test_file_round_trip_and_seek():
    rng = np.random.default_rng(2)
    docs = [(None if k == 0 else k, rng.integers(0, 50_257, n).astype(np.uint32)) for k, n in enumerate([0, 1, 40_000, 0, 3, 16_384])]
    out = io.BytesIO()
    writer = B.TokenFileWriter(out)
    for d, ids in docs:
        writer.add(d, ids)
    writer.close()
    reader = B.TokenFileReader(pa.PythonFile(io.BytesIO(out.getvalue()), mode="r"))
    for (a, x), (b, y) in zip(docs, reader.documents_ids(), strict=True):
        assert a == b and np.array_equal(x, y)
    whole = np.concatenate([x for _, x in docs])
    assert np.array_equal(reader.block(2), whole[2 * B.BLOCK:3 * B.BLOCK])
    with pytest.raises(ValueError):
        B.TokenFileReader(pa.PythonFile(io.BytesIO(b"\0" * 100), mode="r"))


def test_ids_equal_the_librarys():
    enc, rng = encoder(tokenizer_file()), random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "'", "re", "'ve", "s", "1", "2", ".", "!", "é", "\t", "ll", "Z", "_", "̀", "²", "<|endoftext|>",
             "日本", "\x85", "\x1c", "ª", "×", "\xa0", "😀"]
    for k in range(1500):
        text = "".join(rng.choice(parts[:18] if k % 3 else parts) for _ in range(rng.randint(0, 60)))
        assert enc.ids(text).tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids, text


def expected(rows):
    enc = encoder(tokenizer_file()).tokenizer
    out = []
    for r in rows:
        ids = np.array([*enc.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((r[0], len(ids), zlib.crc32(ids.tobytes())))
    return out


def test_documents_round_trip(spark, tmp_dir):
    rows = odd_docs() + [(5, "same id, other text", None, None, None)]
    df = spark.createDataFrame([(*r, 7) for r in rows], DOCS + ", start long").repartition(5)
    manifest = B.write_token_files(df, tokenizer_file(), f"{tmp_dir}/tokens")
    got = B.read_token_files(manifest).collect()

    def key(r):
        return (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(expected(rows), key=key)
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.doc_id or -1 for r in by_start] == sorted(r.doc_id or -1 for r in got)
    total = 0
    for r in by_start:
        assert r.start == total
        total += r.n_tokens
    store, path = locate(manifest.orderBy("part").first().path)
    with store.open_input_file(path) as f:
        assert B.TokenFileReader(f).n_docs > 0


def test_empty_table(spark):
    assert B.token_file_digest(spark.createDataFrame([], DOCS), tokenizer_file()).count() == 0
