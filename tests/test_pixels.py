import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.functions import pixels as px
from tessella.plans.transforms import applied, steps
from tessella.sources.images import parse_ppm

images = st.tuples(st.integers(1, 9), st.integers(1, 9), st.integers(0, 2**32 - 1)).map(
    lambda t: np.random.default_rng(t[2]).integers(0, 256, (t[0], t[1], 3), dtype=np.uint8)
)


@settings(max_examples=40, deadline=None)
@given(images)
def test_round_trips(image):
    assert (px.mirrored(px.mirrored(image)) == image).all()
    a, b = px.split_pair(image)
    assert b.shape[1] - a.shape[1] == image.shape[1] % 2 and (px.beside(a, b) == image).all()
    back = px.image_of(px.tensor(image))
    assert np.abs(back.astype(int) - image.astype(int)).max() <= 1
    light, colour = px.lab_pair(image)
    assert np.abs(px.from_lab_pair(light, colour) - image).max() < 1.0


def test_sizes():
    image = np.zeros((10, 6, 3), np.uint8)
    assert px.sized_by_four(image).shape[:2] == (8, 8)
    assert px.sized_by_four(np.zeros((14, 14, 3), np.uint8)).shape[:2] == (16, 16)
    assert px.scaled_width(image, 6, 8) is image
    assert px.scaled_width(image, 3, 8).shape[:2] == (8, 3)
    assert px.aspect_size(10, 20, 2.0) == (20, 20) and px.aspect_size(10, 20, 0.5) == (10, 40)


@pytest.mark.parametrize("method", ["bicubic", "bilinear", "lanczos", "nearest"])
def test_resampling_keeps_constants_and_ramps(method):
    flat = np.full((7, 5, 3), 77, np.uint8)
    assert (px.resized(flat, 12, 3, method) == 77).all()
    ramp = np.repeat(np.arange(0, 160, 10, dtype=np.uint8)[None, :, None], 4, axis=0).repeat(3, axis=2)
    wide = px.resized(ramp, 32, 4, method).astype(int)
    assert (np.diff(wide[0, 4:-4, 0]) >= 0).all() and abs(int(wide[0, 16, 0]) - 77) <= 6


def test_crop_pads_and_guards():
    image = np.arange(2 * 6 * 3, dtype=np.uint8).reshape(2, 6, 3)
    assert px.cut(image, 0, 0, 6) is image
    out = px.cut(image, 1, 0, 4)
    assert out.shape == (4, 4, 3) and (out[:2] == image[:, 1:5]).all() and not out[2:].any()
    with pytest.raises(ValueError, match="exceeds"):
        px.cut_strictly(image, 0, 0, 4)
    with pytest.raises(ValueError, match="same height"):
        px.beside(image, image[:1])
    with pytest.raises(ValueError, match="outside"):
        px.image_of(np.full((1, 1, 1), 1.5))


def test_colours():
    primaries = np.array([[[255, 0, 0], [0, 255, 0], [0, 0, 255], [255, 255, 255], [0, 0, 0]]], np.uint8)
    published = [(53.24, 80.09, 67.20), (87.73, -86.18, 83.18), (32.30, 79.19, -107.86), (100, 0, 0), (0, 0, 0)]
    assert np.abs(px.lab(primaries)[0] - published).max() < 0.05
    assert px.luma(primaries)[0, :, 0].tolist() == [76, 150, 29, 255, 0]
    blue = px.blue_first(primaries)
    assert blue.shape == (3, 1, 5) and blue[2, 0, 0] == pytest.approx(255 - 73.45286, abs=1e-4)


def test_edge_network_helpers():
    image = np.arange(5 * 5 * 3, dtype=np.uint8).reshape(5, 5, 3)
    assert px.edge_input(image, 3).shape == (3, 11, 11)
    assert px.without_border(np.zeros((200, 190)), 50, 35).shape == (200 - 100, 190 - 100)
    assert px.binary_edges(np.array([0.1, 0.95]), 0.5).tolist() == [1, 0]
    label = np.zeros((7, 7), int)
    label[2:5, 2:5] = 1
    found = px.boundaries(label, 1)
    assert found[2, 2] and not found[3, 3] and not found[0, 0]


def test_transform_plan():
    assert steps("resize_and_crop", 8, 4) == [("resize", 8, 8), ("crop", 4), ("flip",)]
    assert steps("scale_width", 8, 4, flip=False, gray=True) == [("gray",), ("scale_width", 8, 4)]
    assert steps("none", 8, 4) == [("four",), ("flip",)]
    image = np.random.default_rng(0).integers(0, 256, (6, 6, 3), dtype=np.uint8)
    out = applied(image, steps("crop", 8, 4), {"crop_x": 1, "crop_y": 2, "flip": True})
    assert (out == image[2:6, 1:5][:, ::-1]).all()


def test_ppm():
    body = bytes(range(12))
    assert parse_ppm(b"P6\n# note\n2 2\n255\n" + body).tobytes() == body
    with pytest.raises(ValueError):
        parse_ppm(b"P5 2 2 255 " + body)
    assert struct.calcsize(">I") == 4
