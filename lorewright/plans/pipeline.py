"""Step registry, selection and isolated execution.

A step is (key, description, function of a catalog of tables).  Steps are
selected by number, by full key or by the beginning of a key; unknown names
are skipped with a warning; a step named twice runs twice.
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lorewright.operators import collaboration, mapping, vectors
from lorewright.operators.flatten import FLATTENERS
from lorewright.operators.merge import net_new
from lorewright.schemas import merge_keys
from lorewright.sources.flat import output_exists, read_flat, write_flat
from lorewright.sources.snapshots import read_snapshot

log = logging.getLogger(__name__)
Catalog = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Step:
    key: str
    description: str
    output: str
    run: Callable[[Catalog], DataFrame]


@dataclass(frozen=True)
class Outcome:
    key: str
    status: str
    seconds: float
    error: str = ""
    rows: int = 0
    size: int = 0


def success_rate(outcomes: Iterable[Outcome]) -> float:
    """Percent of the steps that did not fail; 100 of none."""
    done = list(outcomes)
    return 100.0 * sum(o.status != "failed" for o in done) / len(done) if done else 100.0


@dataclass(frozen=True)
class Config:
    """What a run needs; read from JSON, unknown keys are refused.

    ``snapshot_dir`` holds nested JSON lines, which are flattened first;
    ``input_dir`` holds tables that are flat already.  One of the two is given.
    """

    output_dir: str
    input_dir: str | None = None
    snapshot_dir: str | None = None
    start_date: str | None = None
    end_date: str = "latest"
    authorship_mode: str = "all"
    catalogue: str | None = None
    export_csv: bool = False
    full_dir: str | None = None
    tables: tuple[str, ...] = ("authors", "topics", "institutions", "works", "works_authorships", "works_topics", "works_referenced_works", "works_biblio")
    column_mappings: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    special_file_paths: Mapping[str, str] = field(default_factory=dict)
    skip_existing: bool = True

    @classmethod
    def load(cls, path: str | Path) -> Config:
        raw = json.loads(Path(path).read_text())
        unknown = set(raw) - set(cls.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown configuration keys: {sorted(unknown)}")
        return cls(**{k: tuple(v) if k == "tables" else v for k, v in raw.items()})


def _text_vectors(df: DataFrame, key: str, text: str, extra: tuple[str, ...] = ()) -> DataFrame:
    keep = [c for c in (key, *extra) if c in df.columns]
    return vectors.encode_text(df, df[text]).select(*keep, "vec")


STEPS: tuple[Step, ...] = (
    Step("01_authors_vertex", "author vertices", "authors_v", lambda c: mapping.vertices(c["authors"], "authors")),
    Step("02_works_vertex", "work vertices", "works_v", lambda c: mapping.vertices(c["works"], "works")),
    Step("03_topics_vertex", "topic vertices", "topics_v", lambda c: mapping.vertices(c["topics"], "topics")),
    Step("04_authors_doc", "author documents", "author_doc", lambda c: mapping.author_documents(c["authors"])),
    Step("05_works_doc", "work documents", "work_doc", lambda c: mapping.work_documents(c["works"], c["works_authorships"], c["works_topics"], c.get("works_biblio"))),
    Step("06_work_topic_edge", "work to topic edges", "work_topic_e", lambda c: mapping.topic_edges(c["works_topics"])),
    Step("07_work_author_edge", "work to author edges", "work_author_e", lambda c: mapping.authorship_edges(c["works_authorships"])),
    Step(
        "08_author_author_edge",
        "weighted co-author edges",
        "author_author_e",
        lambda c: collaboration.collaboration_edges(collaboration.one_version(c["works_authorships"]), c["works"]).select("startid", "endid", "properties"),
    ),
    Step("09_work_reference_edge", "citation edges", "work_referenced_work_e", lambda c: mapping.reference_edges(c["works_referenced_works"])),
    Step("10_works_vector", "work vectors", "works_vector", lambda c: _text_vectors(mapping.work_texts(c["works"]).withColumnRenamed("id", "work_id"), "work_id", "text", ("doi",))),
    Step("11_topics_vector", "topic vectors", "topics_vector", lambda c: _text_vectors(c["topics"], "id", "keywords")),
)


def select_steps(wanted: Iterable[str] | None, steps: tuple[Step, ...] = STEPS) -> list[Step]:
    """The named steps in the order named; all of them when none is named."""
    if wanted is None:
        return list(steps)
    chosen = []
    for w in wanted:
        name = w.strip()
        number = name.zfill(2) if name.isdigit() else name
        hit = next((s for s in steps if s.key == name), None) or next((s for s in steps if s.key.startswith(number)), None)
        if hit is None:
            log.warning("unknown step %s skipped", w)
        else:
            chosen.append(hit)
    return chosen


def _written(spark: SparkSession, path: str) -> tuple[int, int]:
    """Rows, from the files' footers, and bytes of an output."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.parquet(path).count(), int(p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength())


def _write(name: str, path: str, make: Callable[[], DataFrame], spark: SparkSession, skip_existing: bool) -> Outcome:
    """Write one output; a failure is reported, not raised."""
    began = time.time()
    try:
        if skip_existing and output_exists(spark, path):
            return Outcome(name, "skipped", time.time() - began, "", *_written(spark, path))
        make().write.mode("overwrite").parquet(path)
        return Outcome(name, "ok", time.time() - began, "", *_written(spark, path))
    except Exception as e:  # noqa: BLE001
        log.exception("%s failed", name)
        return Outcome(name, "failed", time.time() - began, str(e)[:500])


def run_steps(catalog: Catalog, output_dir: str, wanted: Iterable[str] | None = None, steps: tuple[Step, ...] = STEPS, skip_existing: bool = True) -> list[Outcome]:
    """Write each step's output; a failing step does not stop the others."""
    spark = next(iter(catalog.values())).sparkSession
    return [_write(s.key, f"{output_dir}/{s.output}", lambda s=s: s.run(catalog), spark, skip_existing) for s in select_steps(wanted, steps)]


def flatten_snapshot(spark: SparkSession, config: Config) -> tuple[str, list[Outcome]]:
    """Parquet tables of every entity that the snapshot holds, and what was written."""
    root, outcomes = f"{config.output_dir}/flat", []
    for entity, flatten in FLATTENERS.items():
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{config.snapshot_dir}/{entity}")
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            continue
        options = {"works": {"authorship_mode": config.authorship_mode, "ordinals": True}, "authors": {"catalogue": config.catalogue}, "institutions": {"catalogue": config.catalogue}}
        tables = flatten(read_snapshot(spark, config.snapshot_dir, entity, config.start_date, config.end_date), **options.get(entity, {}))
        outcomes += [_write(f"flatten {t}", f"{root}/{t}", lambda df=df: df, spark, config.skip_existing) for t, df in tables.items()]
    return root, outcomes


def _stored(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def merge_tables(spark: SparkSession, config: Config, flat_dir: str | None = None) -> dict[str, DataFrame]:
    """The net-new rows of every configured table that there is; without a full table every row is new.

    Increments are Parquet where this run flattened them, else flat CSV.
    """
    out = {}
    for t in config.tables:
        if flat_dir and not _stored(spark, f"{flat_dir}/{t}") or not flat_dir and not _stored(spark, f"{config.input_dir}/{t}"):
            continue
        inc = spark.read.parquet(f"{flat_dir}/{t}") if flat_dir else read_flat(spark, f"{config.input_dir}/{t}", recursive=True)
        where = config.special_file_paths.get(t) or (f"{config.full_dir}/{t}" if config.full_dir and _stored(spark, f"{config.full_dir}/{t}") else None)
        full = read_flat(spark, where, recursive=True) if where else None
        out[t] = net_new(inc, full, merge_keys(t), config.column_mappings.get(t))
    return out


def run(spark: SparkSession, config: Config, wanted: Iterable[str] | None = None) -> list[Outcome]:
    """Flatten if asked, merge, then map.

    Tables are Parquet between the stages, so later reads split, prune and
    push down; with ``export_csv`` the merged tables are also written as CSV.
    Each outcome tells rows, bytes and seconds, the merge of a table included.
    """
    if (config.input_dir is None) == (config.snapshot_dir is None):
        raise ValueError("one of input_dir and snapshot_dir is needed")
    flat_dir, outcomes = flatten_snapshot(spark, config) if config.snapshot_dir else (None, [])
    merged = merge_tables(spark, config, flat_dir)
    root = f"{config.output_dir}/merged"
    outcomes += [_write(f"merge {n}", f"{root}/{n}", lambda df=df: df, spark, config.skip_existing) for n, df in merged.items()]
    catalog = {n: spark.read.parquet(f"{root}/{n}") for n in merged if output_exists(spark, f"{root}/{n}")}
    if config.export_csv:
        for n, df in catalog.items():
            if not (config.skip_existing and output_exists(spark, f"{config.output_dir}/csv/{n}")):
                write_flat(df.drop("item_pos", "institution_pos"), f"{config.output_dir}/csv/{n}", mode="overwrite")
    return outcomes + (run_steps(catalog, f"{config.output_dir}/mapped", wanted, skip_existing=config.skip_existing) if catalog else [])
