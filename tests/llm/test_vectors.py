"""Near vectors at the border of what is linked, against all pairs."""

import numpy as np
import pytest

from facilitymetrics.llm.vector_dup import near_vectors


@pytest.mark.parametrize("size", [64, 128])
def test_recall_just_above_the_border(spark, size):
    """Pairs of cosine 0.95 to 0.96, the hardest to find."""
    rng = np.random.default_rng(size)
    rows, wanted = [], 0
    for k in range(400):
        a = rng.normal(size=size)
        a /= np.linalg.norm(a)
        b = rng.normal(size=size)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        cosine = rng.uniform(0.9501, 0.96)
        rows += [(2 * k, (3 * a).tolist()), (2 * k + 1, (cosine * a + np.sqrt(1 - cosine**2) * b).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r["component_id"] for r in near_vectors(frame).collect()}
    wanted = sum(found[2 * k + 1] == 2 * k for k in range(400))
    assert wanted / 400 >= 0.97
    # Nothing below the border is linked.
    m = np.array([v for _, v in rows])
    m /= np.linalg.norm(m, axis=1)[:, None]
    near = (m @ m.T) >= 0.95
    links = {r["vec_id"]: r["n_links"] for r in near_vectors(frame).collect()}
    assert all(links[k] <= near[k].sum() - 1 for k in links)
