import zlib

import numpy as np

from gridweave.llm import token_files
from gridweave.llm.token_packing import pack_documents


def rows_of(df):
    return sorted((r.sequence_id, r.n_tokens, bytes(r.input_ids), bytes(r.position_ids), r.cu_seqlens, r.doc_ids, r.starts) for r in df.collect())


def test_packed_rows_come_back_from_files(spark, messy, nothing, tokenizer_file, tmp_path):
    path = f"file://{tmp_path}/packed"
    packed = pack_documents(messy, tokenizer_file, 64).checkpoint()
    token_files.write_packed(packed, path)
    want = rows_of(packed)
    assert rows_of(token_files.read_packed(spark, path)) == want
    # a loader: matrices of rows by capacity, straight from the files
    about, total = token_files.manifest(path), 0
    for f in about["files"]:
        raw = (tmp_path / "packed" / f"{f['name']}.ids").read_bytes()
        assert zlib.crc32(raw) == f["crc32"]["ids"]
        matrix = np.frombuffer(raw, "<u2").reshape(-1, 64)
        positions = np.fromfile(tmp_path / "packed" / f"{f['name']}.positions", "<u2").reshape(-1, 64)
        assert len(matrix) == len(positions) == f["rows"] and (positions[:, 0] == 0).all()
        total += f["rows"]
    assert total == len(want) and not [p for p in (tmp_path / "packed").iterdir() if p.name.startswith("_")]
    token_files.write_packed(packed.limit(2), path)  # in its place
    assert token_files.read_packed(spark, path).count() == 2 and len(list((tmp_path / "packed").glob("*.ids"))) == len(token_files.manifest(path)["files"])
    token_files.write_packed(pack_documents(nothing, tokenizer_file, 64), path)
    assert token_files.read_packed(spark, path).count() == 0
