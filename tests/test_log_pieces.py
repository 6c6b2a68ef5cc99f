"""Lines of logs are written by pieces of many lines."""

import pyarrow as pa

from capturelake.sources.binary_files import packed_lines


def test_a_piece_holds_a_batch_of_lines():
    b = [pa.RecordBatch.from_pydict({"file": ["a", "a", "b"], "line": ["x", "ü", "z"]}), pa.RecordBatch.from_pydict({"file": ["b"], "line": [""]})]
    assert list(packed_lines(b)) == [("a", 2, "x\nü\n".encode()), ("b", 1, b"z\n"), ("b", 1, b"\n")]
