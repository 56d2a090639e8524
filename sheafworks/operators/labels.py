"""Experiment configurations and class maps of training sets."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafworks import schemas as S

PUBLAYNET = ("text", "title", "list", "table", "figure")
PUBTABNET = ("table_cell",)
DOCLAYNET_VAL = ("val", "test")  # both go into the validation split


@dataclass(frozen=True)
class Settings:
    """One selection: how many images, which classes, which pages. An empty ``elem_accepts`` in a file means all."""

    max_img: int = 0
    elem_drops: tuple[int, ...] = ()
    masters: dict[int, str] = field(default_factory=dict)
    mapping: dict[int, int] = field(default_factory=dict)
    elem_mins: dict[int, int] = field(default_factory=dict)
    elem_accepts: tuple[int, ...] = tuple(range(len(S.ENTITY_NAMES)))
    quality_threshold: float = 0.0
    language_codes: tuple[str, ...] = ()
    language_code_threshold: float = 0.0

    @classmethod
    def parse(cls, raw: dict) -> Settings:
        merge = raw.get("elem_mergings") or {}
        ids = lambda d: {int(k): v for k, v in (d or {}).items()}
        accepts = tuple(map(int, raw.get("elem_accepts") or range(len(S.ENTITY_NAMES))))
        out = cls(int(raw.get("max_img", 0)), tuple(map(int, raw.get("elem_drops") or ())), ids(merge.get("masters")), {k: int(v) for k, v in ids(merge.get("mapping")).items()}, {k: int(v) for k, v in ids(raw.get("elem_mins")).items()}, accepts, float(raw.get("quality_threshold") or 0), tuple(raw.get("language_codes") or ()), float(raw.get("language_code_threshold") or 0))
        for part, master in out.mapping.items():
            if master not in out.masters or master in out.elem_drops or master in out.mapping:
                raise ValueError(f"class {part} is merged into {master}, which is no master of its own")
        return out

    def quotas(self) -> list[Settings]:
        """A selection for each class with a minimum; without minima the settings themselves."""
        if not self.elem_mins:
            return [self]
        return [replace(self, elem_accepts=(k,), max_img=n, elem_mins={}) for k, n in self.elem_mins.items()]


def load(path: str) -> dict[str, Settings]:
    """Training and validation settings of an experiment's JSON or YAML file."""
    text = Path(path).read_text()
    if path.endswith((".yaml", ".yml")):
        import yaml

        raw = yaml.safe_load(text)
    else:
        raw = json.loads(text)
    return {k: Settings.parse(raw[k]) for k in ("train_settings", "val_settings") if k in raw}


def class_map(s: Settings) -> tuple[list[str], dict[int, int]]:
    """Labels by class, and entity id → class. Ids that are neither dropped nor merged get classes in order; merged ids get
    their master's, even those that are dropped too."""
    own = [k for k in range(len(S.ENTITY_NAMES)) if k not in s.elem_drops and k not in s.mapping]
    classes = {k: n for n, k in enumerate(own)}
    return [s.masters.get(k, S.ENTITY_NAMES[k]) for k in own], classes | {k: classes[m] for k, m in s.mapping.items()}


def class_table(spark: SparkSession, s: Settings) -> DataFrame:
    """(category, class, label): a few rows, whatever the data."""
    labels, classes = class_map(s)
    return spark.createDataFrame([(k, c, labels[c]) for k, c in sorted(classes.items())], "category int, class int, label string")


def coco_labels(doc: DataFrame) -> DataFrame:
    """(class, label) as a COCO file's categories name them, in their order: DocLayNet's labels, or any other data set's."""
    return doc.select(F.posexplode("categories").alias("class", "c")).select("class", F.col("c.name").alias("label"))
