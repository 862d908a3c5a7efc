"""Row-wise image features in one pass: images are decoded by Spark's reader, read once as
BGR bytes, and never shuffled."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = {
    "brightness": "double", "dark_blue_gray": "double", "skin_ratio": "double", "vegetation_ratio": "double", "grid_regularity": "double",
    "patch_std": "double", "contrast_std": "double", "high_frequency": "double", "glare": "double", "hash": "array<long>",
}


def pixels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """height x width x 3 (BGR) of raw bytes with 1, 3 or 4 channels."""
    x = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(x, 3, axis=2) if channels == 1 else x[..., :3]


def gray(x: np.ndarray) -> np.ndarray:
    return x @ np.array([0.114, 0.587, 0.299])


def resize(x: np.ndarray, height: int, width: int) -> np.ndarray:
    """Area means when shrinking, bilinear when growing, axis by axis."""

    def axis(n: int, m: int) -> np.ndarray:
        if m <= n:
            edges = np.linspace(0, n, m + 1)
            cover = np.minimum(edges[1:, None], np.arange(1, n + 1)) - np.maximum(edges[:-1, None], np.arange(n))
            return np.maximum(cover, 0) * (m / n)
        at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        lo = np.minimum(at.astype(int), n - 1)
        w = np.zeros((m, n))
        w[np.arange(m), lo] += 1 - (at - lo)
        w[np.arange(m), np.minimum(lo + 1, n - 1)] += at - lo
        return w

    return np.tensordot(axis(x.shape[0], height), np.tensordot(axis(x.shape[1], width), x, (1, 1)), (1, 1))


def thumbnail(x: np.ndarray, longest: int) -> np.ndarray:
    """Shrink so that the longest side has at most ``longest`` pixels; never grow."""
    scale = longest / max(x.shape[:2])
    if scale >= 1:
        return x
    return np.clip(np.rint(resize(x.astype(float), max(1, round(x.shape[0] * scale)), max(1, round(x.shape[1] * scale)))), 0, 255).astype(np.uint8)


def perceptual_hash(x: np.ndarray, side: int = 8) -> list[int]:
    """side^2 bits, as signed 64-bit words: low frequencies of a cosine transform above their
    median."""
    n = 4 * side
    k = np.arange(n)
    basis = np.cos(np.pi * k[:, None] * (2 * k[None, :] + 1) / (2 * n))
    low = (basis @ resize(gray(x), n, n) @ basis.T)[:side, :side]
    bits = (low > np.median(low)).reshape(-1)
    return np.packbits(bits).view(">u8").astype(np.uint64).view(np.int64).tolist()


def hsv(x: np.ndarray) -> np.ndarray:
    """Hue 0 .. 179, saturation and value 0 .. 255."""
    b, g, r = (x[..., i].astype(float) for i in range(3))
    v, lo = x.max(axis=2).astype(float), x.min(axis=2).astype(float)
    d = v - lo
    safe = np.where(d == 0, 1, d)
    h = np.where(v == r, (g - b) / safe, np.where(v == g, 2 + (b - r) / safe, 4 + (r - g) / safe)) * 60
    return np.stack([np.where(d == 0, 0, (h % 360) / 2), np.where(v == 0, 0, d / np.where(v == 0, 1, v) * 255), v], axis=2).round()


def box_share(c: np.ndarray, lo: tuple, hi: tuple) -> float:
    return float(((c >= lo) & (c <= hi)).all(axis=2).mean())


def edges(y: np.ndarray, least: float = 100.0) -> np.ndarray:
    p = np.pad(y, 1, mode="reflect" if min(y.shape) > 1 else "edge")
    s = p[:-2] + 2 * p[1:-1] + p[2:]
    t = p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    return np.hypot(s[:, 2:] - s[:, :-2], t[2:] - t[:-2]) > least


def grid_regularity(y: np.ndarray) -> float:
    """Straight lines in the edge map (peaks of a Hough accumulator) per 100,000 pixels."""
    row, col = np.nonzero(edges(y))
    if not len(row):
        return 0.0
    angles = np.deg2rad(np.arange(0, 180, 2))
    reach = int(np.hypot(*y.shape)) + 1
    rho = np.rint(col[:, None] * np.cos(angles) + row[:, None] * np.sin(angles)).astype(int) + reach
    votes = np.bincount((rho * len(angles) + np.arange(len(angles))).reshape(-1), minlength=(2 * reach + 1) * len(angles))
    return float((votes >= max(10, min(y.shape) // 3)).sum() / (y.size / 1e5))


def patch_std(y: np.ndarray, n: int = 3, scorer: Callable[[np.ndarray], float] | None = None) -> float:
    """Population deviation of the means (or of another score) of n x n patches."""
    parts = [p for band in np.array_split(y, n) for p in np.array_split(band, n, axis=1) if p.size]
    return float(np.std([scorer(p) if scorer else p.mean() for p in parts]))


def contrast_std(y: np.ndarray, block: int = 16) -> float:
    """Deviation of the deviations of blocks; the block that ends at the border is left out."""
    h, w = len(range(0, y.shape[0] - block, block)), len(range(0, y.shape[1] - block, block))
    if not h or not w:
        return 0.0
    tiles = y[: h * block, : w * block].reshape(h, block, w, block)
    return float(tiles.std(axis=(1, 3)).std())


def high_frequency(y: np.ndarray) -> float:
    """Share of the spectrum's magnitude outside a quarter of the smaller side."""
    f = np.abs(np.fft.fftshift(np.fft.fft2(y)))
    i, j = np.ogrid[: y.shape[0], : y.shape[1]]
    outside = (i - y.shape[0] // 2) ** 2 + (j - y.shape[1] // 2) ** 2 > (min(y.shape) // 4) ** 2
    return float(f[outside].sum() / (f.sum() + 1e-8))


def glare(y: np.ndarray) -> float:
    """Variance of the Laplacian on the brightest tenth; 0 for fewer than 50 pixels."""
    if min(y.shape) < 2:
        return 0.0
    p = np.pad(y, 1, mode="reflect")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * y
    own = lap[y >= np.percentile(y, 90)]
    return float(own.var()) if len(own) >= 50 else 0.0


def residual(x: np.ndarray, sigma: float = 3.0) -> np.ndarray:
    """Mean absolute difference to a blurred copy, scaled by its largest value to 0 .. 255."""
    r = int(3 * sigma)
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    k /= k.sum()

    def blur(a: np.ndarray, axis: int) -> np.ndarray:
        pad = [(r, r) if i == axis else (0, 0) for i in range(3)]
        return np.apply_along_axis(lambda v: np.convolve(v, k, "valid"), axis, np.pad(a, pad, mode="edge"))

    d = np.abs(x.astype(float) - blur(blur(x.astype(float), 0), 1)).mean(axis=2)
    return np.zeros(d.shape, np.uint8) if not d.max() else np.rint(d / d.max() * 255).astype(np.uint8)


def features_of(x: np.ndarray, hash_side: int = 8) -> dict:
    y, c = gray(x), hsv(x)
    h, s, v = c[..., 0], c[..., 1], c[..., 2]
    return {
        "brightness": float(y.mean()),
        "dark_blue_gray": float(((v < 120) & ((s < 60) | ((h > 90) & (h < 140)))).mean()),
        "skin_ratio": box_share(c, (0, 30, 60), (25, 150, 255)),
        "vegetation_ratio": box_share(c, (35, 40, 40), (85, 255, 255)),
        "grid_regularity": grid_regularity(y),
        "patch_std": patch_std(y),
        "contrast_std": contrast_std(y),
        "high_frequency": high_frequency(y),
        "glare": glare(y),
        "hash": perceptual_hash(x, hash_side),
    }


def image_features(images: DataFrame, hash_side: int = 8) -> DataFrame:
    """(id, features, hash) of (id, height, width, n_channels, data).  A row that cannot be read
    has a null hash and zero features."""
    kind = images.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                try:
                    out.append({"id": row.id, **features_of(pixels(row.data, row.height, row.width, row.n_channels), hash_side)})
                except (ValueError, TypeError):
                    out.append({"id": row.id, **{k: None if t.startswith("array") else 0.0 for k, t in FEATURES.items()}})
            yield pd.DataFrame(out, columns=["id", *FEATURES])

    schema = f"id {kind}, " + ", ".join(f"{k} {t}" for k, t in FEATURES.items())
    return images.select("id", "height", "width", "n_channels", "data").mapInPandas(run, schema)


def prepare(images: DataFrame, fn: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Images with ``fn`` (such as a thumbnail or the residual channel) applied to the pixels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [fn(pixels(r.data, r.height, r.width, r.n_channels)) for r in pdf.itertuples(index=False)]
            size = lambda i: [x.shape[i] if x.ndim > i else 1 for x in out]
            yield pd.DataFrame({"id": pdf["id"], "height": size(0), "width": size(1), "n_channels": size(2), "data": [x.astype(np.uint8).tobytes() for x in out]})

    kind = images.schema["id"].dataType.simpleString()
    return images.select("id", "height", "width", "n_channels", "data").mapInPandas(run, f"id {kind}, height int, width int, n_channels int, data binary")


def embed(rows: DataFrame, fn: Callable[[pd.DataFrame], np.ndarray], out: str = "vec", id_col: str = "id") -> DataFrame:
    """(id, out): vectors from a user's model, which gets a batch of rows and is called in the
    tasks; give it an object that loads its weights on first use."""
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf[id_col], out: list(np.asarray(fn(pdf), np.float32))})

    return rows.mapInPandas(run, f"id {kind}, {out} array<float>")


def color_grid(pdf: pd.DataFrame, side: int = 4) -> np.ndarray:
    """A default embedding: mean colours and gradients of a grid of patches."""
    out = []
    for r in pdf.itertuples(index=False):
        small = resize(pixels(r.data, r.height, r.width, r.n_channels).astype(float), side, side)
        out.append(np.concatenate([small.reshape(-1), np.diff(gray(small), axis=0).reshape(-1), np.diff(gray(small), axis=1).reshape(-1)]) / 255)
    return np.array(out)


def rasters_from_vectors(vectors: DataFrame, side: int = 32) -> DataFrame:
    """Images drawn from (id, vec): an 8 x 8 board of the first 64 components, enlarged."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            boards = [np.resize(np.asarray(v, float), 64).reshape(8, 8) for v in pdf["vec"]]
            big = [np.kron(np.clip(b * 400 + 128, 0, 255), np.ones((side // 8, side // 8))) for b in boards]
            data = [np.stack([b, np.roll(b, 3, 0), np.roll(b, 5, 1)], axis=2).astype(np.uint8).tobytes() for b in big]
            yield pd.DataFrame({"id": pdf["id"], "height": side, "width": side, "n_channels": 3, "data": data})

    return vectors.select("id", F.col("vec")).mapInPandas(run, "id long, height int, width int, n_channels int, data binary")
