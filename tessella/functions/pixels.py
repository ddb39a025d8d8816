"""Pixel functions on numpy arrays (height, width, channels) of bytes, and their Arrow-batched form over image rows.

They are the operations that columns cannot express: cutting, mirroring, resampling, colour spaces. An image row holds
(width, height, n_channels, pixels); pixels is row-major HWC in RGB order.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

Image = np.ndarray


def luma(image: Image) -> Image:
    """One channel of ITU-R 601-2 luma, in 16-bit fixed point with rounding."""
    r, g, b = (image[..., c].astype(np.int64) for c in range(3))
    return ((r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16).astype(np.uint8)[..., None]


def split_pair(image: Image) -> tuple[Image, Image]:
    """Left and right half; with an odd width the right one is wider by one."""
    half = image.shape[1] // 2
    return image[:, :half], image[:, half:]


def beside(a: Image, b: Image) -> Image:
    if a.shape[0] != b.shape[0]:
        raise ValueError("images side by side need the same height")
    return np.concatenate([a, b], axis=1)


def cut(image: Image, x: int, y: int, size: int) -> Image:
    """A square from (x, y); zeros beyond the image; an image that exceeds it on neither side stays as it is."""
    h, w, c = image.shape
    if w <= size and h <= size:
        return image
    out = np.zeros((size, size, c), image.dtype)
    part = image[y : y + size, x : x + size]
    out[: part.shape[0], : part.shape[1]] = part
    return out


def cut_strictly(image: Image, x: int, y: int, size: int) -> Image:
    """As ``cut``, but an image smaller than the square raises."""
    if image.shape[0] < size or image.shape[1] < size:
        raise ValueError(f"crop {size} exceeds image {image.shape[1]} x {image.shape[0]}")
    return image[y : y + size, x : x + size]


def mirrored(image: Image) -> Image:
    return image[:, ::-1]


def _cubic(x: np.ndarray, a: float = -0.5) -> np.ndarray:
    x = np.abs(x)
    near = ((a + 2) * x - (a + 3)) * x * x + 1
    far = ((x - 5) * x + 8) * x * a - 4 * a
    return np.where(x < 1, near, np.where(x < 2, far, 0.0))


def _lanczos(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)


#: Interpolation methods: kernel and the half width of its support.
KERNELS: dict[str, tuple[Callable, float]] = {
    "bicubic": (_cubic, 2.0),
    "bilinear": (lambda x: np.maximum(0.0, 1 - np.abs(x)), 1.0),
    "lanczos": (_lanczos, 3.0),
}


@lru_cache(maxsize=256)
def _taps(size: int, to: int, method: str) -> tuple[np.ndarray, np.ndarray]:
    """(taps, to) positions and weights of one axis; a kernel is widened when an axis shrinks. Unused taps weigh 0."""
    kernel, support = KERNELS[method]
    scale = size / to
    wide = max(scale, 1.0)
    centre = (np.arange(to) + 0.5) * scale
    low = np.maximum(0, (centre - support * wide + 0.5).astype(int))
    high = np.minimum(size, (centre + support * wide + 0.5).astype(int))
    at = low + np.arange((high - low).max())[:, None]
    weights = np.where(at < high, kernel((at - centre + 0.5) / wide), 0.0)
    return np.minimum(at, size - 1), weights / weights.sum(0)


def _resampled(image: np.ndarray, axis: int, to: int, method: str) -> np.ndarray:
    """One pass along an axis, rounded to whole values of a byte: work grows with the taps, not with the image's size."""
    at, weights = _taps(image.shape[axis], to, method)
    shape = [1, 1, 1]
    shape[axis] = to
    total = sum(np.take(image, k, axis) * w.reshape(shape) for k, w in zip(at, weights, strict=True))
    return np.clip(np.floor(total + 0.5), 0, 255)


def resized(image: Image, width: int, height: int, method: str = "bicubic") -> Image:
    """Separable resampling, each pass rounded to bytes. Agrees with the formulas; not compared to another library."""
    h, w, _ = image.shape
    if (w, h) == (width, height):
        return image
    if method == "nearest":
        rows = ((np.arange(height) + 0.5) * h / height).astype(int)
        columns = ((np.arange(width) + 0.5) * w / width).astype(int)
        return image[rows][:, columns]
    out = image.astype(float)
    if w != width:
        out = _resampled(out, 1, width, method)
    if h != height:
        out = _resampled(out, 0, height, method)
    return out.astype(np.uint8)


def scaled_width(image: Image, target: int, crop: int, method: str = "bicubic") -> Image:
    h, w, _ = image.shape
    if w == target and h >= crop:
        return image
    return resized(image, target, int(max(target * h / w, crop)), method)


def sized_by_four(image: Image, method: str = "bicubic") -> Image:
    """Both sides rounded to multiples of 4, halves to even."""
    h, w, _ = image.shape
    return resized(image, int(round(w / 4) * 4), int(round(h / 4) * 4), method)


def tensor(image: Image) -> np.ndarray:
    """CHW floats in [-1, 1]."""
    half = np.float32(0.5)
    return ((image.astype(np.float32) / np.float32(255) - half) / half).transpose(2, 0, 1)


def image_of(values: np.ndarray) -> Image:
    """HWC bytes of a CHW tensor, cut toward zero; one channel becomes three. Values outside [-1, 1] raise."""
    if values.size and (values.min() < -1 or values.max() > 1):
        raise ValueError("value outside [-1, 1]")
    if values.shape[0] == 1:
        values = np.repeat(values, 3, axis=0)
    return ((values.transpose(1, 2, 0) + 1) / 2.0 * 255.0).astype(np.uint8)


#: sRGB to XYZ for the D65 white point (published constants), and that white point.
TO_XYZ = np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]])
WHITE = np.array([0.95047, 1.0, 1.08883])


def lab(image: Image) -> np.ndarray:
    """CIE L*a*b* of an sRGB image, as floats HWC."""
    v = image.astype(float) / 255
    linear = np.where(v > 0.04045, ((v + 0.055) / 1.055) ** 2.4, v / 12.92)
    t = linear @ TO_XYZ.T / WHITE
    f = np.where(t > 0.008856, np.cbrt(t), 7.787 * t + 16 / 116)
    x, y, z = f[..., 0], f[..., 1], f[..., 2]
    return np.stack([116 * y - 16, 500 * (x - y), 200 * (y - z)], axis=-1)


def rgb(values: np.ndarray) -> np.ndarray:
    """sRGB in [0, 1] of L*a*b*."""
    y = (values[..., 0] + 16) / 116
    x, z = values[..., 1] / 500 + y, np.maximum(0, y - values[..., 2] / 200)
    f = np.stack([x, y, z], axis=-1)
    t = np.where(f > 0.2068966, f**3, (f - 16 / 116) / 7.787) * WHITE
    linear = t @ np.linalg.inv(TO_XYZ).T
    out = np.where(linear > 0.0031308, 1.055 * np.maximum(linear, 0) ** (1 / 2.4) - 0.055, 12.92 * linear)
    return np.clip(out, 0, 1)


def lab_pair(image: Image) -> tuple[np.ndarray, np.ndarray]:
    """Lightness and colour tensors: L / 50 - 1 and (a, b) / 110, CHW."""
    v = lab(image).astype(np.float32).transpose(2, 0, 1)
    return v[:1] / np.float32(50) - np.float32(1), v[1:] / np.float32(110)


def from_lab_pair(light: np.ndarray, colour: np.ndarray) -> np.ndarray:
    """HWC floats in [0, 255] from lightness and colour tensors."""
    v = np.concatenate([(light + 1) * 50, colour * 110]).transpose(1, 2, 0).astype(float)
    return rgb(v) * 255


def blue_first(image: Image, mean: tuple[float, float, float] = (72.78044, 83.21195, 73.45286)) -> np.ndarray:
    """CHW floats in the order B, G, R less a mean in that order."""
    return (image[..., 2::-1].astype(np.float32) - np.array(mean, np.float32)).transpose(2, 0, 1)


#: Mean of the edge network's input (fixed values), in the order B, G, R.
EDGE_MEAN = (104.00698793, 116.66876762, 122.67891434)


def edge_input(image: Image, border: int = 128) -> np.ndarray:
    """Reflected borders, three channels, then as ``blue_first`` with the edge network's mean."""
    wide = np.pad(image[..., :3], ((border, border), (border, border), (0, 0)), mode="reflect")
    return blue_first(wide, EDGE_MEAN)


def without_border(scores: np.ndarray, border: int = 128, offset: int = 35) -> np.ndarray:
    """A score map without the border and the network's offset."""
    return scores[border + offset : -border + offset or None, border + offset : -border + offset or None]


def binary_edges(scores: np.ndarray, threshold: float) -> np.ndarray:
    """Edge strengths inverted and thresholded: the first step of edge simplification, the only one built here."""
    return (1 - scores >= max(np.finfo(float).eps, threshold)).astype(np.uint8)


def boundaries(label: np.ndarray, thickness: int, void: int = 255) -> np.ndarray:
    """Pixels on object boundaries: dilation and erosion of the labelled mask by a disk differ."""
    mask = (label > 0) & (label != void)
    r = thickness
    offsets = [(y, x) for y in range(-r, r + 1) for x in range(-r, r + 1) if x * x + y * y <= r * r]
    h, w = mask.shape
    low, high = np.pad(mask, r, constant_values=True), np.pad(mask, r, constant_values=False)
    grown = np.zeros_like(mask)
    shrunk = np.ones_like(mask)
    for y, x in offsets:
        grown |= high[r + y : r + y + h, r + x : r + x + w]
        shrunk &= low[r + y : r + y + h, r + x : r + x + w]
    return grown ^ shrunk


def aspect_size(width: int, height: int, ratio: float) -> tuple[int, int]:
    """Size at which a sink stores an image: a ratio above 1 widens it, one below 1 heightens it."""
    if ratio > 1.0:
        return int(width * ratio), height
    return (width, int(height / ratio)) if ratio < 1.0 else (width, height)


def over_images(df: DataFrame, transform: Callable[[Image, dict], Image], parameters: tuple[str, ...] = ()) -> DataFrame:
    """Image rows with ``transform(image, row's parameters)`` applied to pixels and sizes updated, in Arrow batches."""

    def run(batches):
        for b in batches:
            names = b.schema.names
            at = {n: names.index(n) for n in ("width", "height", "n_channels", "pixels", *parameters)}
            columns = {n: b.column(k).to_pylist() for n, k in at.items()}
            out = []
            for k in range(b.num_rows):
                shape = columns["height"][k], columns["width"][k], columns["n_channels"][k]
                image = np.frombuffer(columns["pixels"][k], np.uint8).reshape(shape)
                out.append(transform(image, {p: columns[p][k] for p in parameters}))
            fresh = {
                "height": pa.array([x.shape[0] for x in out], pa.int32()),
                "width": pa.array([x.shape[1] for x in out], pa.int32()),
                "n_channels": pa.array([x.shape[2] for x in out], pa.int32()),
                "pixels": pa.array([np.ascontiguousarray(x).tobytes() for x in out], pa.binary()),
            }
            for n, column in fresh.items():
                b = b.set_column(at[n], n, column)
            yield b

    return df.mapInArrow(run, df.schema)


def rescaled_height(load: int, width: int, height: int) -> int:
    return math.floor(load * height / width)
