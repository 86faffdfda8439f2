import tracemalloc

import pyarrow as pa

from sabermill.llm import quality
from sabermill.llm.tables import stretches


def test_stretches_hold_all_rows_in_order_and_few_bytes():
    left, right = [None, "", "a" * 90, "é" * 20, "b", None, "c" * 500, "d"] * 9, ["x" * (i % 7) for i in range(72)]
    for bound in (1, 50, 200, 1 << 20):
        parts = list(stretches(bound, pa.array(left).slice(0, 72), pa.array(["", *right]).slice(1)))
        assert [v for a, _ in parts for v in a] == left and [v for _, b in parts for v in b] == right
        assert all(sum(len((x or "").encode()) + len(y) + 1 for x, y in zip(a[1:], b[1:], strict=True)) <= bound for a, b in parts)
    assert list(stretches(10, pa.array([], pa.string()))) == []


def test_features_of_a_batch_take_a_bounded_part_of_memory():
    texts = pa.array([" ".join(f"w{i * j % 977}" for j in range(400)) for i in range(1, 1200)])  # 2 MB
    tracemalloc.start()
    for (some,) in stretches(quality._BATCH_BYTES, texts):
        quality.features(some)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 << 20
