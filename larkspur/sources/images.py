"""Pictures to vectors: crops, seeded variants and batched scoring in Arrow batches, with the decoder and the model given in.

Arrays are height x width x 3, uint8. Decoding bytes needs a decoder (`bytes -> array`), a model is any function from a
(n, 3, 224, 224) float32 batch to (n, dim); both are named `module:function` so that executors import them once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .http import load

# Picture size, crop, channel means and deviations, variants.
SIZE, INSET = 224, 0.08
MEAN, STD = np.array([0.485, 0.456, 0.406], np.float32), np.array([0.229, 0.224, 0.225], np.float32)
VARIANTS = ("clean", "blur_lo", "jpeg_lo", "glare_mild")


def scan(spark, path: str) -> DataFrame:
    """path, length, content of every file under a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "content")


def crop_inset(a: np.ndarray, ratio: float = INSET) -> np.ndarray:
    h, w = a.shape[:2]
    dx, dy = int(w * ratio), int(h * ratio)
    left, top = min(dx, max(0, w - 1)), min(dy, max(0, h - 1))
    return a[top : max(top + 1, h - dy), left : max(left + 1, w - dx)]


def resize(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, with pixel centres aligned; float32."""
    def axis(n: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        low = np.floor(at).astype(int)
        return low, np.minimum(low + 1, n - 1), (at - low).astype(np.float32)

    y0, y1, fy = axis(a.shape[0], height)
    x0, x1, fx = axis(a.shape[1], width)
    a = a.astype(np.float32)
    fy = fy.reshape(-1, *([1] * (a.ndim - 1)))
    rows = a[y0] * (1 - fy) + a[y1] * fy
    fx = fx.reshape(1, -1, *([1] * (a.ndim - 2)))
    return rows[:, x0] * (1 - fx) + rows[:, x1] * fx


def base_image(a: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(resize(crop_inset(a), SIZE, SIZE)), 0, 255).astype(np.uint8)


def to_input(a: np.ndarray) -> np.ndarray:
    """(3, 224, 224), normalized."""
    return ((a.astype(np.float32) / 255.0 - MEAN) / STD).transpose(2, 0, 1)


def longest_edge(a: np.ndarray, most: int) -> np.ndarray:
    h, w = a.shape[:2]
    if max(h, w) <= most:
        return a
    scale = most / max(h, w)
    return np.clip(np.rint(resize(a, int(h * scale), int(w * scale))), 0, 255).astype(np.uint8)


def gray(a: np.ndarray) -> np.ndarray:
    return a.astype(np.float32) @ np.array([0.299, 0.587, 0.114], np.float32)


def frame_pixels(a: np.ndarray, size: int = 8) -> np.ndarray:
    """size * size gray values, for functions.vectors.average_hash."""
    return np.rint(resize(gray(a), size, size)).reshape(-1)


def blur(a: np.ndarray, radius: float) -> np.ndarray:
    reach = max(1, int(3 * radius + 0.5))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / radius) ** 2).astype(np.float32)
    kernel /= kernel.sum()
    out = a.astype(np.float32)
    for dim in (0, 1):
        pad = [(reach, reach) if d == dim else (0, 0) for d in range(out.ndim)]
        wide = np.pad(out, pad, mode="edge")
        out = sum(k * np.take(wide, range(i, i + out.shape[dim]), axis=dim) for i, k in enumerate(kernel))
    return out


def _block_noise(a: np.ndarray, quality: int) -> np.ndarray:
    """What coarse JPEG tables do to 8 x 8 blocks: a cosine transform whose coefficients are rounded by `quality`."""
    n = np.arange(8)
    basis = np.cos((2 * n[None, :] + 1) * n[:, None] * np.pi / 16) * np.where(n[:, None] == 0, np.sqrt(1 / 8), np.sqrt(2 / 8))
    step = np.maximum(1.0, (1 + n[:, None] + n[None, :]) * (100 - quality) / 12)
    h, w = a.shape[0] // 8 * 8, a.shape[1] // 8 * 8
    out = a.astype(np.float32).copy()
    tiles = out[:h, :w].reshape(h // 8, 8, w // 8, 8, -1)
    freq = np.einsum("ij,ajbkc,lk->aiblc", basis, tiles, basis, optimize=True)
    freq = np.rint(freq / step[None, :, None, :, None]) * step[None, :, None, :, None]
    out[:h, :w] = np.einsum("ji,ajbkc,kl->aiblc", basis, freq, basis, optimize=True).reshape(h, w, -1)
    return out


def variant(a: np.ndarray, tag: str, draw: np.random.Generator) -> np.ndarray:
    """One of VARIANTS of a base image; `draw` is seeded by card and variant."""
    if tag == "clean":
        return a
    if tag == "blur_lo":
        h, w = a.shape[:2]
        out = resize(resize(blur(a, draw.uniform(0.6, 1.0)), max(1, int(h * 0.71)), max(1, int(w * 0.71))), h, w)
    elif tag == "jpeg_lo":
        out = _block_noise(a, int(draw.integers(50, 61))) * draw.uniform(0.92, 1.08)
        middle = gray(np.clip(out, 0, 255)).mean()
        out = middle + (out - middle) * draw.uniform(0.92, 1.08)
    elif tag == "glare_mild":
        out = a + glare(a.shape[:2], draw, (0.3, 0.7), (0.25, 0.75), (0.10, 0.20), (0.08, 0.16), (45.0, 80.0), 0.0)[..., None]
    else:
        raise ValueError(f"unknown variant {tag}")
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def glare(shape: tuple[int, int], draw: np.random.Generator, cx: tuple, cy: tuple, sx: tuple, sy: tuple, strength: tuple, turn: float) -> np.ndarray:
    """A bright elliptical spot."""
    yy, xx = np.meshgrid(np.linspace(0, 1, shape[0]), np.linspace(0, 1, shape[1]), indexing="ij")
    x, y, angle = xx - draw.uniform(*cx), yy - draw.uniform(*cy), draw.uniform(-turn, turn) if turn else 0.0
    u, v = x * np.cos(angle) - y * np.sin(angle), x * np.sin(angle) + y * np.cos(angle)
    return np.exp(-0.5 * ((u / draw.uniform(*sx)) ** 2 + (v / draw.uniform(*sy)) ** 2)) * draw.uniform(*strength)


def perturb(a: np.ndarray, draw: np.random.Generator, degrees: float = 9.0, shift: float = 0.04) -> np.ndarray:
    """A query view: rotated and shifted about the centre, edges repeated, with glare and sensor noise from the row's own seed."""
    h, w = a.shape[:2]
    t = np.deg2rad(draw.uniform(-degrees, degrees))
    dy, dx = draw.uniform(-shift, shift) * h, draw.uniform(-shift, shift) * w
    yy, xx = np.meshgrid(np.arange(h) - h / 2, np.arange(w) - w / 2, indexing="ij")
    y = np.clip(np.rint(yy * np.cos(t) - xx * np.sin(t) + h / 2 + dy), 0, h - 1).astype(int)
    x = np.clip(np.rint(yy * np.sin(t) + xx * np.cos(t) + w / 2 + dx), 0, w - 1).astype(int)
    out = a[y, x].astype(np.float32)
    if draw.random() < 0.35:
        out = out + glare((h, w), draw, (0.2, 0.8), (0.15, 0.85), (0.05, 0.18), (0.04, 0.14), (90.0, 180.0), 1.0)[..., None]
    out = (out + draw.normal(0, draw.uniform(1, 4), out.shape)) * draw.uniform(0.9, 1.1)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def skip_reason(url, failed, valid):
    """Why a card has no usable picture: no URL, a failed download, an unreadable file, in this order; null if it has one."""
    return F.when(F.coalesce(F.trim(url), F.lit("")) == "", "missing_image_url").when(failed, "download_failed").when(~F.coalesce(valid, F.lit(False)), "invalid_image")


def validate(images: DataFrame, decoder: str, key: str = "path") -> DataFrame:
    """key, valid: whether the decoder reads the bytes."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode = load(decoder)
        for pdf in frames:
            ok = []
            for b in pdf["content"]:
                try:
                    ok.append(decode(bytes(b)) is not None)
                except Exception:  # noqa: BLE001  a picture that cannot be read is the result asked for
                    ok.append(False)
            yield pd.DataFrame({key: pdf[key], "valid": ok})

    return images.select(key, "content").mapInPandas(run, f"{key} string, valid boolean")


def embed(images: DataFrame, decoder: str, model: str, key: str = "card_id", dim: int = 256, variants: tuple[str, ...] = VARIANTS, model_name: str = "embedder", batch: int = 32) -> DataFrame:
    """Rows of the embeddings table: each picture in each variant, scored in batches, unit length, finite, of `dim` numbers.

    The model is loaded once a task. A result of another shape, or one that is not finite, raises.
    """
    import hashlib

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decode: Callable = load(decoder)
        score: Callable = load(model)
        for pdf in frames:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch]
                names, inputs = [], []
                for k, content in zip(part[key], part["content"], strict=True):
                    base = base_image(decode(bytes(content)))
                    for i, tag in enumerate(variants):
                        seed = int.from_bytes(hashlib.sha256(f"{k}|{i}".encode()).digest()[:8], "big")
                        inputs.append(to_input(variant(base, tag, np.random.default_rng(seed))))
                        names.append((k, i, tag))
                out = np.asarray(score(np.stack(inputs)), np.float32)
                if out.shape != (len(names), dim) or not np.isfinite(out).all():
                    raise ValueError(f"the model gave {out.shape}, finite: {np.isfinite(out).all()}")
                out = out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)
                yield pd.DataFrame({"card_id": [n[0] for n in names], "model_name": model_name, "variant_idx": [n[1] for n in names], "variant_tag": [n[2] for n in names], "dim": dim, "vector": list(out)})

    return images.select(key, "content").mapInPandas(run, "card_id string, model_name string, variant_idx int, variant_tag string, dim int, vector array<float>")
