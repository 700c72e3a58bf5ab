"""Sample sinks: chips partitioned by split and size, products as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastertable.schema import band_columns

PRODUCTS = ("image", "ndvi", "mask", "image_z")


def gz_name(path: Column) -> Column:
    """Replace the last extension by ``gz``."""
    return F.concat(F.regexp_replace(path, r"\.[^.]*$", ""), F.lit(".gz"))


def export_name(path: str, product: str) -> Column:
    """Name of one exported chip, from its split, size and window_id columns."""
    folder = F.concat(
        F.lit(path.rstrip("/") + "/"), F.col("split"), F.lit("/"),
        F.col("size"), F.lit("x"), F.col("size"), F.lit("/"),
    )
    number = F.col("window_id").cast("string")
    # Name patterns of the four products (fixed values).
    tail = {
        "image": F.concat(number, F.lit(".tiff")),
        "ndvi": F.concat(F.lit("ndvi/"), number, F.lit(".tiff")),
        "mask": F.concat(F.lit("mask/"), number, F.lit(".tiff")),
        "image_z": F.concat(number, F.lit("-z.tiff")),
    }[product]
    return F.concat(folder, tail)


def product_view(chips: DataFrame, product: str) -> DataFrame:
    """One product of the chips in the shape (keys.., b0 .. bN)."""
    keys = [c for c in ("split", "size", "window_id", "crs", "extent", "x0", "y0", "x1", "y1",
                        "px", "py", "w", "h", "cols", "rows") if c in chips.columns]
    if product == "image":
        cells = [F.col(b) for b in band_columns(chips)]
    elif product == "image_z":
        cells = [F.col(f"z_{b}").alias(b) for b in band_columns(chips)]
    elif product in ("ndvi", "mask"):
        cells = [F.col(product).alias("b0")]
    else:
        raise ValueError(f"unknown product {product}")
    return chips.select(*keys, F.lit(product).alias("product"), *cells)


def write_samples(chips: DataFrame, path: str, gzip: bool = False, mode: str = "error") -> None:
    """Write chips once, all products side by side in columns.

    One pass over the plan serves every product, and a reader of one product
    reads its columns only.  ``path`` may be on any Hadoop file system.
    """
    chips.write.mode(mode).option("compression", "gzip" if gzip else "snappy").partitionBy(
        "split", "size"
    ).parquet(path)


def write_products(chips: DataFrame, path: str, products=PRODUCTS, gzip: bool = False, mode: str = "error") -> None:
    """Write each product to its own partition ``split=/size=/product=``.

    Runs the plan of ``chips`` once per product: pass chips read back from
    ``write_samples``.
    """
    for product in products:
        view = product_view(chips, product)
        split_size = [c for c in ("split", "size") if c in view.columns]
        view.drop("product").write.mode(mode).option(
            "compression", "gzip" if gzip else "snappy"
        ).partitionBy(*split_size).parquet(f"{path.rstrip('/')}/product={product}")
