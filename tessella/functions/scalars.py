"""String, path, relabelling and log-line functions, all native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: File extensions of images (fixed values; compared with case).
IMAGE_EXTENSIONS = (".jpg", ".JPG", ".jpeg", ".JPEG", ".png", ".PNG", ".ppm", ".PPM", ".bmp", ".BMP", ".tif", ".TIF", ".tiff", ".TIFF")


def is_image(path: Column) -> Column:
    """Whether a path ends in one of the extensions; a spelling such as .Jpg does not count."""
    found = F.lit(False)
    for extension in IMAGE_EXTENSIONS:
        found = found | F.endswith(path, F.lit(extension))
    return found


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """Base name without its last suffix; a leading dot is not a suffix."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def joined_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def padded(number: Column, digits: int) -> Column:
    return F.format_string(f"%0{digits}d", number)


def frame_of(path: Column) -> Column:
    """City, shot and frame of a label file's base name."""
    return F.array_join(F.slice(F.split(base_name(path), "_"), 1, 3), "_")


def loss_line(rank: Column, epoch: Column, iters: Column, t_comp: Column, t_data: Column, losses: Column) -> Column:
    """The log line of a step; ``losses`` is an ordered array of (name, value)."""
    head = F.format_string("[Rank %d] (epoch: %d, iters: %d, time: %.3f, data: %.3f) ", rank, epoch, iters, t_comp, t_data)
    tail = F.array_join(F.transform(losses, lambda x: F.format_string(", %s: %.3f", x["name"], x["value"])), "")
    return F.concat(head, tail)


LINE_HEAD = r"^\[Rank (\d+)\] \(epoch: (\d+), iters: (\d+), time: ([0-9.]+), data: ([0-9.]+)\) "


def parsed_line(line: Column) -> Column:
    """(rank, epoch, iters, t_comp, t_data, losses) of a log line."""
    part = lambda k, kind: F.regexp_extract(line, LINE_HEAD, k).cast(kind)
    tail = F.regexp_replace(line, LINE_HEAD, "")
    names, values = (F.regexp_extract_all(tail, F.lit(r", ([^:,]+): (-?[0-9.]+|-?inf|nan)"), F.lit(k)) for k in (1, 2))
    losses = F.zip_with(names, values, lambda n, v: F.struct(n.alias("name"), v.cast("double").alias("value")))
    return F.struct(
        part(1, "int").alias("rank"), part(2, "int").alias("epoch"), part(3, "long").alias("iters"),
        part(4, "double").alias("t_comp"), part(5, "double").alias("t_data"), losses.alias("losses"),
    )


def relabelled(label: Column, mapping: dict[int, int]) -> Column:
    """Labels after one replacement after the other, in the map's order: a later key also meets what an earlier one wrote.

    The result wraps to a byte, so -1 becomes 255.
    """
    out = label.cast("int")
    for k, v in mapping.items():
        out = F.when(out == k, F.lit(v)).otherwise(out)
    return F.pmod(out, F.lit(256)).cast("int")


def archive_links(html: Column, suffixes: tuple[str, ...] = (".zip", "tar.gz")) -> Column:
    """Targets of anchors that end in one of the suffixes."""
    links = F.regexp_extract_all(html, F.lit(r"""<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1))
    wanted = lambda x: F.greatest(*[F.endswith(x, F.lit(s)) for s in suffixes], F.lit(False))
    return F.filter(links, wanted)


def transposed(data: Column, channels: int) -> Column:
    """HWC array to CHW."""
    per = (F.size(data) / channels).cast("int")
    return F.transform(F.sequence(F.lit(0), F.size(data) - 1), lambda k: F.get(data, (k % per) * channels + F.floor(k / per).cast("int")))


def argmax(values: Column) -> Column:
    """Position of the largest value, the first of equal ones."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def multiple_of_four(size: Column) -> Column:
    """The size rounded to a multiple of 4, halves to even."""
    return (F.bround(size / 4) * 4).cast("int")


def scaled_size(width: Column, height: Column, target: int, crop: int) -> Column:
    """(width, height) after scaling to a target width; unchanged if it has that width and is high enough."""
    fits = (width == target) & (height >= crop)
    new_h = F.greatest(F.lit(target) * height / width, F.lit(float(crop))).cast("int")
    return F.struct(F.when(fits, width).otherwise(F.lit(target)).alias("width"), F.when(fits, height).otherwise(new_h).alias("height"))


def normalised(pixels: Column) -> Column:
    """Bytes to floats in [-1, 1]."""
    return F.transform(pixels, lambda v: (((v.cast("float") / F.lit(255.0).cast("float")).cast("float") - 0.5) / 0.5).cast("float"))


def denormalised(values: Column) -> Column:
    """Floats in [-1, 1] to bytes, cut toward zero; a value out of range raises."""
    scale = lambda x: ((x.cast("double") + 1) / 2 * 255).cast("int")
    bad = F.raise_error(F.lit("value outside [-1, 1]")).cast("int")
    return F.transform(values, lambda x: F.when((x >= -1) & (x <= 1), scale(x)).otherwise(bad))


def bgr_minus_mean(r: Column, g: Column, b: Column, mean: tuple[float, float, float] = (72.78044, 83.21195, 73.45286)) -> Column:
    """Channels in the order B, G, R less the mean, which is in that order too."""
    less = lambda c, m: c.cast("float") - F.lit(m).cast("float")
    return F.array(less(b, mean[0]), less(g, mean[1]), less(r, mean[2]))


def swapped(direction: Column, a: Column, b: Column) -> Column:
    """(input, target) by direction."""
    forward = direction == "AtoB"
    return F.struct(F.when(forward, a).otherwise(b).alias("input"), F.when(forward, b).otherwise(a).alias("target"))


def coloured(label: Column, palette: dict[int, tuple[int, int, int]]) -> Column:
    """Colour (r, g, b) of a class; classes without one are black."""
    out = F.array(F.lit(0), F.lit(0), F.lit(0))
    for k, (r, g, b) in palette.items():
        out = F.when(label == k, F.array(F.lit(r), F.lit(g), F.lit(b))).otherwise(out)
    return out
