"""What a task leaves in its Python worker."""

import weakref

import numpy as np
import pyarrow as pa
import pytest

from accountwise.llm import decontaminate, near_dedup, texts


class Caught:
    """Stands for a DataFrame; keeps the function that tasks would run."""

    columns = ["doc_id", "digest", "body"]

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def test_batches_are_gone_when_a_worker_is_tidied(monkeypatch):
    seen, alive = [], []
    monkeypatch.setattr(texts, "finished", lambda: alive.append([r() is not None for r in seen]))

    def batches():
        for k in range(2):
            batch = pa.RecordBatch.from_pydict({"doc_id": [k], "digest": [b"x"], "body": ["one two three four five six"]})
            seen.append(weakref.ref(batch))
            yield batch
            del batch

    task = near_dedup.signed(Caught(), "body", 5, 25, 5, 256).run
    assert sum(b.num_rows for b in task(batches())) == 2
    assert alive == [[False, False]]


def test_marks_of_items_are_made_once():
    items = decontaminate.Items([(1, "a b c d e f g h i j")], 5, 48)
    assert "_marked" not in vars(items)
    first = items.marked()
    h, offsets = texts.word_hashes(pa.array(["x y a b c d e f g h i j z"], pa.large_string()), fold=True)
    assert items.candidates(*texts.shingle_hashes(h, offsets, 5)) == {(0, 0)}
    assert items.marked() is first


@pytest.mark.parametrize("size", [64, 1 << 18, 1 << 20])
def test_hashes_do_not_follow_the_slices(monkeypatch, size):
    column = pa.array([" ".join(f"w{k * n}" for k in range(40)) for n in range(60)], pa.large_string())
    monkeypatch.setattr(texts, "SLICE_BYTES", size)
    parts = [texts.word_hashes(column.slice(a, b - a))[0] for a, b in texts.slices(column)]
    whole = texts.word_hashes(column)[0]
    assert np.array_equal(np.concatenate(parts), whole)
