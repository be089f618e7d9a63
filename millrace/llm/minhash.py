"""MinHash samples and odd sketches of shingle sets."""

from __future__ import annotations

import numpy as np

from millrace.llm.words import U, mixed

BANDS, ROWS = 32, 4
#: MinHash samples of a set.
SAMPLES = BANDS * ROWS
#: Bits of an odd sketch.
SKETCH_BITS = 512
_generator = np.random.Generator(np.random.PCG64(20_240_229))
_FACTORS = (_generator.integers(1, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1))[:, None]
_SHIFTS = _generator.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)[:, None]
_PLACES = np.arange(SAMPLES, dtype=np.uint64) * U(0x9E3779B97F4A7C15)


def samples(shingles: np.ndarray) -> np.ndarray:
    """``SAMPLES`` minima of a non-empty set, each under a hash of its own."""
    x = (shingles >> U(32)).astype(np.uint32)
    low = None
    for at in range(0, len(x), 2048):
        hashed = x[at : at + 2048] * _FACTORS
        hashed += _SHIFTS
        part = hashed.min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """One number per band; sets that agree in all samples of a band share it."""
    rows = low.reshape(BANDS, ROWS).astype(U)
    keys = np.arange(BANDS, dtype=U)
    for k in range(ROWS):
        keys = mixed(keys * U(0xD6E8FEB86659FD93) + rows[:, k])
    return keys


def odd_sketch(low: np.ndarray) -> np.ndarray:
    """Parity of the samples that fall on each of ``SKETCH_BITS`` bits, as 64-bit words.

    Samples that two sets share cancel in the XOR of their sketches, so its
    population count counts the samples in which they differ, less collisions.
    """
    bits = mixed(_PLACES + low) % U(SKETCH_BITS)
    parity = (np.bincount(bits.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(U)


def estimated_similarity(differing_bits: float) -> float:
    """Similarity of two sets whose odd sketches differ in so many bits."""
    share = min(2 * differing_bits / SKETCH_BITS, 1 - 1e-9)
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(1 - share)


def most_differing_bits(similarity: float, sigmas: float = 6.0) -> int:
    """Bits that the sketches of sets of at least ``similarity`` differ in at most.

    Of ``SAMPLES`` samples a share of 1 - similarity differs, within ``sigmas`` standard
    deviations of a binomial count but for a chance near 1e-9; a differing sample sets two bits at most.
    """
    mean = SAMPLES * (1 - similarity)
    spread = np.sqrt(SAMPLES * similarity * (1 - similarity))
    return 2 * int(np.ceil(mean + sigmas * spread))
