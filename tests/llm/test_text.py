import pyarrow as pa

from roomtide.llm.text import slices


def test_slices_keep_every_row_in_order_and_the_bound():
    sizes = [0, 5, 3000, 1, 1, 70_000, 2, 40_000, 0, 0, 9] * 7
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), pa.array(["x" * n for n in sizes])], names=["id", "text"])
    parts = list(slices([batch, batch.slice(0, 0), batch.slice(3, 5)], 10_000))
    assert [i for p in parts for i in p.column(0).to_pylist()] == [*range(len(sizes)), *range(3, 8)]
    assert [len(t) for p in parts for t in p.column(1).to_pylist()] == sizes + sizes[3:8]
    assert all(p.num_rows == 1 or p.nbytes <= 10_000 for p in parts)
