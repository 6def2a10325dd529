"""What a profiling run and an assessment are asked to do."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from .functions.times import DEFAULT_VOLATILITY_HOURS
from .operators.consistency import Rule, parse_rule
from .operators.inference import ColumnTypes
from .operators.selection import Range
from .operators.sketches import LG_K
from .plans.summary import distinct_key_sets
from .sources.readers import TextLayout

GLOBAL, ATTRIBUTE, VALUE, TUPLE = "global", "attribute", "value", "tuple"

# The levels of detail each dimension offers.
GRANULARITIES = {
    "Volume": (GLOBAL, VALUE),
    "Completeness_Missing": (GLOBAL, ATTRIBUTE, VALUE, TUPLE),
    "Accuracy": (GLOBAL, ATTRIBUTE, VALUE),
    "Precision": (GLOBAL, ATTRIBUTE, VALUE),
    "Timeliness": (GLOBAL, ATTRIBUTE, VALUE, TUPLE),
    "Completeness_Frequency": (GLOBAL, ATTRIBUTE, VALUE),
    "Distinctness": (GLOBAL, ATTRIBUTE),
    "Completeness_Population": (ATTRIBUTE,),
    "Consistency": (ATTRIBUTE, VALUE, TUPLE),
}
EXACT, SKETCH = "exact", "sketch"       # what a source keeps of its distinct values
REFRESH_SUFFIX = "-R"           # of Consistency: score the rows again even with unchanged binding lists


@dataclass(frozen=True)
class ProfileSpec:
    """One source: where its state lives and how its batches read.

    ``columns`` names the fields of JSON batches; without it the first batch is read once more to find them. ``options``
    are those of Spark's reader for the other formats. ``distinct_state`` says whether the source keeps its distinct values, or
    sketches of 2^``sketch_lg_k`` registers whose counts are estimates; the first batch's choice holds for the source.
    """

    result_folder: str
    volatility_hours: float = DEFAULT_VOLATILITY_HOURS
    time_formats: tuple[str, ...] = ()
    binding_paths: tuple[str, ...] = ()
    file_format: str = "json"
    layout: TextLayout | None = None
    columns: tuple[str, ...] | None = None
    digits_only: bool = False
    options: Mapping[str, str] = field(default_factory=dict)
    distinct_state: str = EXACT
    sketch_lg_k: int = LG_K

    def __post_init__(self):
        if self.distinct_state not in (EXACT, SKETCH):
            raise ValueError(f"a source keeps {EXACT!r} or {SKETCH!r} distinct values, got {self.distinct_state!r}")

    @property
    def all_time_formats(self) -> tuple[str, ...]:
        """Formats to try on texts: those given, then those of the layout."""
        return tuple(dict.fromkeys(self.time_formats + (self.layout.time_formats if self.layout else ())))


def granularities(dimension: str, asked: Sequence[str]) -> tuple[str, ...]:
    """Levels to compute; none asked means the whole table."""
    if dimension not in GRANULARITIES:
        raise ValueError(f"unknown dimension {dimension!r}; known: {', '.join(GRANULARITIES)}")
    levels = tuple(dict.fromkeys(a for a in asked if a)) or (GLOBAL,)
    wrong = [a for a in levels if a not in GRANULARITIES[dimension]]
    if wrong:
        raise ValueError(f"{dimension} has no level {', '.join(wrong)}; "
                         f"it offers {', '.join(GRANULARITIES[dimension])}")
    return levels


@dataclass(frozen=True)
class AssessmentSpec:
    """One assessment. Mappings are keyed by column; ``None`` batches are all batches of the source.

    Distinctness of whole rows groups the rows, or with ``digest_rows`` their digests; with ``hash_rows`` it shuffles hashes first
    and then only rows that may be repeated. The answer is the same.
    """

    columns: tuple[str, ...]
    dimensions: Mapping[str, Sequence[str]]
    key_sets: Sequence[Sequence[str]] = ()
    source_folder: str | None = None
    output_folder: str | None = None
    batches: tuple[str, ...] | None = None
    ranges: Mapping[str, Sequence[Range]] = field(default_factory=dict)
    values: Mapping[str, Sequence[str]] = field(default_factory=dict)
    volatility_hours: Mapping[str, float] = field(default_factory=dict)
    expected: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    extra_rules: Sequence[Rule] = ()
    binding_paths: tuple[str, ...] = ()
    refresh_association: bool = False
    source_summary: bool = False
    sample: float = 1.0
    seed: int | None = None
    digest_rows: bool = False
    hash_rows: bool = False
    file_format: str = "parquet"

    def __post_init__(self):
        if self.source_summary:
            return
        if not self.columns:
            raise ValueError("an assessment needs at least one column")
        sets = distinct_key_sets(self.key_sets)
        unknown = {c for k in sets for c in k} - set(self.columns)
        if unknown:
            raise ValueError(f"key sets name columns that are not selected: {sorted(unknown)}")
        if not 0 < self.sample <= 1:
            raise ValueError(f"the sampled fraction must be in (0, 1], got {self.sample}")
        object.__setattr__(self, "columns", tuple(dict.fromkeys(self.columns)))
        object.__setattr__(self, "key_sets", sets)
        object.__setattr__(self, "dimensions", {d: granularities(d, g) for d, g in self.dimensions.items()})

    def levels(self, dimension: str) -> Sequence[str]:
        return self.dimensions.get(dimension, ())

    def asks(self, dimension: str, *levels: str) -> bool:
        return any(level in self.levels(dimension) for level in levels)

    @classmethod
    def from_lines(cls, lines: Sequence[str], types: ColumnTypes, sample: float = 1.0) -> "AssessmentSpec":
        """An assessment written as 14 positional lines.

        In order: source folder and batches; output folder; columns; key sets; ranges and allowed values per
        column; dimensions; validity per time column; expected mean and interval width per numeric column; extra
        rules; levels per dimension; summary only (0 or 1); binding lists. ``types`` tells which columns the
        positional lists speak of: those of the right kind among the selected, in the order of the source.
        """
        if len(lines) < 14:
            raise ValueError(f"a configuration has 14 lines, got {len(lines)}")
        part = [line.rstrip("\n").split(";") for line in lines]
        common = {"source_folder": part[0][0], "output_folder": lines[1].strip(), "sample": sample,
                  "batches": None if part[0][1:] in ([], ["*"]) else tuple(part[0][1:])}
        if int(lines[12]):
            return cls(columns=(), dimensions={}, source_summary=True, **common)
        columns = tuple(part[2])
        refresh = any(d.endswith(REFRESH_SUFFIX) for d in part[6])
        names = [d.removesuffix(REFRESH_SUFFIX) for d in part[6]]
        levels = dict(zip(names, [g.split(",") for g in part[11]]))

        def of_kind(dimension: str) -> list[str]:
            return [c for c in types.columns_for(dimension) if c in columns]

        def per_column(cells: Sequence[str]) -> dict[str, list[str]]:
            return {c: text.split(",") for c, text in zip(columns, cells) if text}

        def decimal(text: str) -> float:
            return float(text.replace(",", "."))

        return cls(
            columns=columns, key_sets=[k.split(",") for k in part[3] if k],
            ranges={c: [Range.parse(r) for r in texts] for c, texts in per_column(part[4]).items()},
            values=per_column(part[5]), dimensions={d: levels.get(d, []) for d in names},
            volatility_hours={c: float(v) for c, v in zip(of_kind("Timeliness"), part[7]) if v},
            expected={c: (decimal(m), decimal(w))
                      for c, m, w in zip(of_kind("Accuracy"), part[8], part[9]) if m and w},
            extra_rules=[r for r in map(parse_rule, part[10]) if r],
            binding_paths=tuple(p for p in part[13] if p), refresh_association=refresh, **common)
