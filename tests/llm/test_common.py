"""Batches handed to tasks."""

import pyarrow as pa
import pytest

from pulsetrail.llm.common import gathered, lean, sizes


@pytest.mark.parametrize("rows", [1, 3, 100])
def test_gathered_batches_keep_rows_and_size(rows):
    texts = ["a" * (i % 7) for i in range(60)] + ["b" * 50, None, "", "c"]
    table = pa.table([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    found = list(gathered(iter(table.to_batches(rows)), "text", 20))
    assert pa.Table.from_batches(found).to_pydict() == table.to_pydict()
    # A text that is larger than the limit comes alone, all others stay below it.
    assert all(int(sizes(b.column("text")).sum()) <= 20 or b.num_rows == 1 for b in found)
    assert len(found) < 20
    assert list(gathered(iter([]), "text", 20)) == []


def test_lean_passes_batches_and_errors_on():
    def run(batches):
        for batch in batches:
            if batch == 2:
                raise KeyError(batch)
            yield batch

    assert list(lean(run)(iter([0, 1]))) == [0, 1]
    with pytest.raises(KeyError):
        list(lean(run)(iter([1, 2])))
