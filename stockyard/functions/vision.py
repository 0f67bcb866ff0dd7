"""Expressions on boxes, labels and colour statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockyard.functions.scalars import col, let

# Class ids of the detector.
WAREHOUSE_CLASSES = {0: "pallet", 1: "box", 2: "crate", 3: "drum",
                     4: "container", 5: "forklift", 6: "person", 7: "truck"}

# Colour rules in the order in which labels are listed.
COLOUR_RULES = [
    ("industrial", 0.75, lambda r, g, b, sd: (r > 150) & (g < 100)),
    ("food", 0.65, lambda r, g, b, sd: g > 120),
    ("electronics", 0.70, lambda r, g, b, sd: b > 130),
    ("fragile", 0.55, lambda r, g, b, sd: sd > 60),
]
FALLBACK_LABEL = ("apparel", 0.50)


def box_class(w: Column | str = "w", h: Column | str = "h") -> Column:
    aspect = col(w) / F.greatest(col(h), F.lit(1))
    return F.when(aspect > 1.2, "pallet").when(aspect < 0.8, "crate").otherwise("box")


def box_confidence(area: Column | str = "area") -> Column:
    return F.least(F.lit(0.95), F.lit(0.5) + col(area) / F.lit(10000.0))


def xyxy(x: Column | str = "x", y: Column | str = "y", w: Column | str = "w", h: Column | str = "h") -> Column:
    x, y, w, h = map(col, (x, y, w, h))
    return F.array(x, y, x + w, y + h)


def flip_box(bbox: Column, width: Column | int) -> Column:
    """Mirror an xyxy box inside an image of the given width."""
    width = width if isinstance(width, Column) else F.lit(width)
    return F.array(width - bbox[2], bbox[1], width - bbox[0], bbox[3])


def caption(class_name: Column | str = "class_name", confidence: Column | str = "confidence") -> Column:
    """``class 0.87``: a confidence in [0, 1] to two digits, rounded on its exact binary value.

    Scaled by 2^53 the confidence is a whole number, so the rounding is done on integers
    (halves to even); formatting the decimal form would round numbers such as 0.565 up.
    """
    scaled = (col(confidence) * F.lit(float(1 << 53))).cast("bigint") * 100
    low, rest = F.shiftright(scaled, 53), scaled.bitwiseAND(F.lit((1 << 53) - 1))
    half = F.lit(1 << 52)
    digits = low + F.when((rest > half) | ((rest == half) & (low % 2 == 1)), 1).otherwise(0)
    return F.format_string("%s %d.%02d", col(class_name), F.floor(digits / 100), digits % 100)


def class_name(class_id: Column | str, names: dict[int, str] | None = None) -> Column:
    """Name of a class id; ids outside the map become ``class_<id>``."""
    names = WAREHOUSE_CLASSES if names is None else names
    lookup = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    return F.coalesce(F.try_element_at(lookup, col(class_id).cast("int")),
                      F.concat(F.lit("class_"), col(class_id).cast("string")))


def _label(name: str, confidence: float) -> Column:
    return F.struct(F.lit(name).alias("label"), F.lit(confidence).cast("double").alias("confidence"))


def colour_labels(r: Column | str = "r", g: Column | str = "g", b: Column | str = "b",
                  sd: Column | str = "sd") -> Column:
    """array<struct<label,confidence>> from mean colours and overall spread."""
    r, g, b, sd = map(col, (r, g, b, sd))
    hits = F.filter(F.array(*[F.when(rule(r, g, b, sd), _label(n, c)) for n, c, rule in COLOUR_RULES]),
                    lambda x: x.isNotNull())
    return F.when(F.size(hits) > 0, hits).otherwise(F.array(_label(*FALLBACK_LABEL)))


def primary_label(labels: Column) -> Column:
    """First label, or ``unknown`` with confidence 0 for an empty list."""
    return F.coalesce(F.try_element_at(labels, F.lit(1)), _label("unknown", 0.0))


def has_label(labels: Column, name: str) -> Column:
    return F.exists(labels, lambda x: x["label"] == name)


def label_text(labels: Column) -> Column:
    return F.concat_ws(",", F.transform(labels, lambda x: F.format_string("%s:%.2f", x["label"], x["confidence"])))


def softmax(values: Column) -> Column:
    powers = let(F.struct(values.alias("v"), F.array_max(values).alias("top")),
                 lambda r: F.transform(r["v"], lambda x: F.exp(x - r["top"])))
    return let(powers, lambda p: let(
        F.struct(p.alias("p"), F.aggregate(p, F.lit(0.0), lambda s, x: s + x).alias("total")),
        lambda r: F.transform(r["p"], lambda x: x / r["total"])))
