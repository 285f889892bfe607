"""Technical-data packages: a manifest, model files and documents below one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headgate.operators.aggregates import entity_counts
from headgate.sources.listing import DOCUMENT_EXTENSIONS, MODEL_EXTENSIONS, list_files
from headgate.sources.manifest import read_manifest
from headgate.sources.tables import FULL_TABLE, UnknownEntity

# The entities of a package, and where each is kept.
MANIFEST = "bom_manifest"
MODELS = "cad_models"
DOCUMENTS = "documents"
MANIFEST_FILE = "BOM_Manifest_With_Docs.csv"
MODELS_FOLDER = "3D_Models"
DOCUMENTS_FOLDER = "Documents"
PRIMARY_KEYS = {MANIFEST: "part_number", MODELS: "path", DOCUMENTS: "path"}


def read_package(spark: SparkSession, root: str, entity: str, mode: str = FULL_TABLE) -> DataFrame:
    """One entity of a package; packages are always read in full."""
    if mode != FULL_TABLE:
        raise ValueError(f"packages cannot be read in mode {mode}")
    root = root.rstrip("/")
    if entity == MANIFEST:
        return read_manifest(spark, f"{root}/{MANIFEST_FILE}")[0]
    if entity == MODELS:
        return list_files(spark, f"{root}/{MODELS_FOLDER}", MODEL_EXTENSIONS)
    if entity == DOCUMENTS:
        return list_files(spark, f"{root}/{DOCUMENTS_FOLDER}", DOCUMENT_EXTENSIONS)
    raise UnknownEntity(f"unknown entity: {entity}")


def package_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows per entity of a package."""
    return entity_counts({e: read_package(spark, root, e) for e in PRIMARY_KEYS})
