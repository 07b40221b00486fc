"""Run a whole study: spine, modules, combined dataset, each written as it is done; go on from what is written."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linkcohort.config import Config
from linkcohort.plans.combine import combine_summaries, summaries
from linkcohort.plans.steps import CENSUS, FINAL, SPINE, STEPS, Step
from linkcohort.sources import (
    Mark, Tables, checked_root, content_key, discover, in_shared_dir, key_of, load_bucketed, open_table, read_marks,
    save_bucketed, save_step, schema_from, shared_dir, write_mark, write_table,
)

BY_PERSON = "by_person"  # what the names of summaries laid out by person begin with
IDS = ("pmr", "tpid")
ONLY_COMBINED = ("attended_only", "attendance", "phenotype_from", "phenotype_to", "exclusion_kinds")  # settings no module reads


@dataclass
class Study:
    """Sources, codelists and settings of one study.

    ``tables`` is a session (its catalog's tables and views) or a mapping of names
    to DataFrames. ``codelists`` may hold births, multiple_still_births, chronic,
    presentations, presentations_medical, emergency_admissions, inception; ``csv`` may
    hold cla and cin, or in place of cin referrals, their yearly snapshots; ``register`` is a school register (urn, type1, type2). Modules whose
    inputs are missing are skipped.

    Every step is written below ``root`` (by default the session's checkpoint
    folder) in a folder called ``name`` (by default one of its own for each run) and
    read back, so a step never repeats the ones before it and survives the loss
    of executors.

    A mark is written after each step, of what it was made from: settings, names and
    columns of its tables, contents of its codelists, the steps it read, and ``version``,
    by which data that change under the same names can be told apart. Another run
    in the same folder goes on: finished steps are read, and steps that were begun
    only are written anew. A step finished from something else is an error until
    it is forgotten. The blocks ``run_spine``, ``run_modules`` and ``run_combine`` can be
    called one by one, in one session or in several.

    With ``buckets``, modules' results are also written one row per person in so many
    buckets of the id, and the combined dataset joins them without a shuffle. As
    many buckets as the session has shuffle partitions, or more, serve best.

    While a step is written, its rows, missing values, linked people and broken
    rules are counted, with no second read; ``report`` returns that.
    """

    spark: SparkSession
    tables: Tables
    codelists: Mapping[str, DataFrame]
    config: Config = Config()
    csv: Mapping[str, DataFrame] = field(default_factory=dict)
    root: str | None = None
    name: str = field(default_factory=lambda: f"study-{uuid.uuid4().hex}")
    register: DataFrame | None = None
    buckets: int = 0
    version: str = ""

    def __post_init__(self):
        self.csv = self.csv or {}

    @property
    def folder(self) -> str:
        if not self.root:
            root = shared_dir(self.spark)
        else:
            root = self.root.rstrip("/") if in_shared_dir(self.spark, self.root) else checked_root(self.spark, self.root)
        return f"{root}/{self.name}"

    def save(self, df: DataFrame, step: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write rows of one's own beside the steps; an error if there are any of that name."""
        return save_step(df, step, self.folder, partition_by)

    # What is there -----------------------------------------------------------

    @cached_property
    def marks(self) -> dict[str, Mark]:
        return read_marks(self.spark, self.folder)

    def finished(self) -> list[str]:
        """The steps that need not be made again."""
        return sorted(n for n, m in self.marks.items() if m.finished)

    def load(self, step: str) -> DataFrame:
        """A finished step as it was written."""
        mark = self.marks.get(step)
        if mark is None or not mark.finished:
            raise ValueError(f"step {step!r} is not finished")
        path = f"{self.folder}/{step}"
        if mark.buckets:
            return load_bucketed(self.spark, path, schema_from(mark), mark.by, mark.buckets)
        return self.spark.read.schema(schema_from(mark)).parquet(path)

    def forget(self, *steps: str) -> None:
        """Let steps, and all that were made from them, be made again. Their files stay until then."""
        gone = {s for s in steps if s in self.marks}
        while more := {n for n, m in self.marks.items() if n not in gone and any(i.split("@")[0] in gone for i in m.inputs)}:
            gone |= more
        for s in gone:
            self._mark(replace(self.marks[s], finished=False))

    def report(self) -> DataFrame:
        """``step``, ``measure`` (rows, missing, linked, broken), ``item`` (column or rule), ``n`` of all finished steps."""
        rows = [(m.step, *k.partition(":")[::2], n) for m in self.marks.values() if m.finished for k, n in m.measures.items()]
        cols = list(zip(*sorted(rows))) or [(), (), (), ()]
        kinds = {"step": pa.string(), "measure": pa.string(), "item": pa.string(), "n": pa.int64()}
        return self.spark.createDataFrame(pa.table({c: pa.array(v, t) for (c, t), v in zip(kinds.items(), cols)}))

    # What can be made --------------------------------------------------------

    def has(self, pattern: str, years: Iterable[int] | None = None) -> bool:
        return bool(discover(self.tables, pattern, years))

    def available(self) -> list[str]:
        """The modules whose inputs are there, in order."""
        out = []
        for s in STEPS.values():
            ready = all(self.has(*f) for f in s.families(self.config)) and set(s.lists) <= set(self.codelists) and set(s.csv) <= set(self.csv)
            ready = ready and (not s.any_csv or bool(set(s.any_csv) & set(self.csv)))
            if s.name != SPINE and ready and s.wanted(self.config) and all(r == SPINE or r in out for r in s.reads):
                out.append(s.name)
        return out

    def _inputs(self, step: Step) -> list[str]:
        names = sorted({n for f in step.families(self.config) for n in discover(self.tables, *f)})
        reading_all = step.name in (SPINE, CENSUS)  # whose families depend on the settings
        if reading_all:
            names = sorted(discover(self.tables, "", None))
        tables = [f"{n}:{open_table(self.tables, n).schema.simpleString()}" for n in names]
        csv = [f"{n}:{self.csv[n].schema.simpleString()}" for n in (*step.csv, *step.any_csv) if n in self.csv]
        if step.name == "demographics_ever" and self.register is not None:
            csv.append(f"register:{self.register.schema.simpleString()}")
        return tables + csv + [f"{n}:{self._list_keys[n]}" for n in (step.lists or (self.codelists if reading_all else ())) if n in self._list_keys]

    @cached_property
    def _list_keys(self) -> dict[str, str]:
        return {n: content_key(df) for n, df in self.codelists.items()}

    def _settings(self, step: str) -> dict:
        return {k: v for k, v in asdict(self.config).items() if step == FINAL or k not in ONLY_COMBINED}

    def _key(self, step: str, inputs: Sequence[str], read: Sequence[str]) -> tuple[str, tuple[str, ...]]:
        runs = tuple(f"{r}@{self.marks[r].run}" for r in read)
        return key_of(step, self.version, sorted(self._settings(step).items(), key=str), list(inputs), runs), runs

    # Making it ---------------------------------------------------------------

    def _mark(self, mark: Mark) -> None:
        write_mark(self.spark, self.folder, mark)
        self.marks[mark.step] = mark

    def _measures(self, df: DataFrame, rules: Mapping[str, str]) -> dict[str, object]:
        out = {"rows:": F.count(F.lit(1))} | {f"missing:{c}": F.count_if(F.col(c).isNull()) for c in df.columns}
        if set(IDS) <= set(df.columns):
            out["linked:"] = F.count_if(F.col("pmr").isNotNull() & F.col("tpid").isNotNull())
        return out | {f"broken:{name}": F.count_if(~F.expr(rule)) for name, rule in rules.items()}

    def _write(self, step: str, make, key: str, runs: tuple[str, ...], rules: Mapping[str, str] = {}, partition_by: Sequence[str] = (), by: str = "") -> DataFrame | None:
        """The finished step, made and marked if it is not there yet."""
        mark = self.marks.get(step)
        if mark is not None and mark.finished:
            if mark.key != key:
                raise ValueError(f"step {step!r} was made from other inputs or settings; forget it, or use another name")
            return self.load(step) if mark.schema else None
        if mark is None and step in STEPS:
            mark = Mark(step, key, finished=False)
        if mark is not None:  # begun: until it is finished, its files may be broken
            self._mark(replace(mark, finished=False))
        df = make()
        if df is None:
            self._mark(Mark(step, key, inputs=runs))
            return None
        seen = Observation(step)
        measures = self._measures(df, rules)
        watched = df.observe(seen, *[c.alias(f"m{i}") for i, c in enumerate(measures.values())])
        path, buckets = f"{self.folder}/{step}", self.buckets if by else 0
        if buckets:
            save_bucketed(watched, path, by, buckets)
        else:
            write_table(watched, path, partition_by=partition_by)
        got = seen.get
        counted = {k: int(got[f"m{i}"] or 0) for i, k in enumerate(measures)}
        self._mark(Mark(step, key, True, json.dumps(df.schema.jsonValue()), runs, by if buckets else "", buckets, counted))
        return self.load(step)

    def step(self, name: str) -> DataFrame | None:
        """One step, read if it is finished, else made, as are those it reads; None if its sources have nothing for it."""
        s = STEPS[name]
        done = {r: self.step(r) for r in s.reads}
        if any(df is None for df in done.values()):
            return None
        key, runs = self._key(name, self._inputs(s), s.reads)
        return self._write(name, lambda: s.build(self, done), key, runs, s.rules, s.partition_by)

    def run_spine(self) -> DataFrame:
        return self.step(SPINE)

    def run_modules(self, only: Iterable[str] | None = None, skip: Iterable[str] = ()) -> dict[str, DataFrame]:
        """The modules' results by name: all whose inputs are there, or only some, each with the steps it reads."""
        unknown = {*(only or ()), *skip} - set(STEPS)
        if unknown:
            raise ValueError(f"no such modules: {sorted(unknown)}")
        names = [n for n in self.available() if (only is None or n in set(only)) and n not in set(skip)]
        made = {n: self.step(n) for n in names}
        return {n: df for n, df in made.items() if df is not None and STEPS[n].part}

    def run_combine(self, skip: Iterable[str] = ()) -> DataFrame:
        """The combined dataset of the modules that are finished, without those of ``skip``."""
        spine = self.run_spine()
        parts = {n: self.load(n) for n in STEPS if STEPS[n].part and n in self.finished() and self.marks[n].schema and n not in set(skip)}
        of = summaries(parts, self.config)
        if self.buckets:
            for n, x in of.items():
                name = f"{BY_PERSON}_{n}"
                key, runs = self._key(name, [str(self.buckets), *map(str, self._settings(FINAL).items())], [n])
                of[n] = replace(x, rows=self._write(name, lambda x=x: x.rows, key, runs, by=x.on))
        key, runs = self._key(FINAL, sorted(of), [SPINE, *sorted(of)])
        # the hospital id shares out people without a pupil id among the sorted files
        made = lambda: combine_summaries(spine, of, self.config).orderBy(*[c for c in ("pmr", "y7_year", "tpid") if c in spine.columns])
        return self._write(FINAL, made, key, runs)

    def run(self, skip: Iterable[str] = ()) -> DataFrame:
        """Spine, each module, combined dataset, going on from what is written; returns the last."""
        self.run_spine()
        self.run_modules(skip=skip)
        return self.run_combine(skip)
