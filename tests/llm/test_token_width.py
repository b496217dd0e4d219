import io

import numpy as np
import pyarrow as pa
import pytest

from biblioforge.llm.token_files import TokenFileReader, TokenFileWriter


def test_wide_ids_are_kept_or_refused():
    ids = np.array([1, 65_535, 65_536, 200_000], "<u4").tobytes()
    with pytest.raises(ValueError, match="200000"):
        TokenFileWriter(io.BytesIO(), 2).add(7, ids)
    for width, kept in ((2, ids[:8]), (4, ids)):
        sink = io.BytesIO()
        writer = TokenFileWriter(sink, width)
        writer.add(7, kept)
        writer.close()
        assert TokenFileReader(pa.BufferReader(sink.getvalue())).ids(0) == kept
