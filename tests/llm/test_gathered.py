"""What a fit gathers on the driver is held once."""

import tracemalloc

import numpy as np
import pyarrow as pa

from runlens.llm import quality_classifier


def test_gathered_terms_are_held_once():
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.3, (900, quality_classifier.N_TERMS + 1)).astype(np.float32)
    counts[:5] = 0  # texts without bytes
    terms = pa.chunked_array([pa.array(list(part), pa.list_(pa.float32())) for part in (counts[:0], counts[:400], counts[400:])])
    tracemalloc.start()
    found = quality_classifier._gathered(terms)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    plain = counts.astype(np.float64)
    want = quality_classifier._weights(plain[:, :-1], plain[:, -1])
    assert np.array_equal(found, want) and peak < 2.5 * want.nbytes  # lists of numbers take more than twice as much
    quality_classifier._to_unit(found)
    assert np.array_equal(found, quality_classifier._unit(want))
