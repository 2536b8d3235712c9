"""The query interface: an immutable builder over one wide table."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .predicates import conjunction, predicate, unique
from .ranking import md5_key, per_group, seeded_order


@dataclass(frozen=True)
class Profile:
    """A table and its well-known columns."""

    name: str
    id_col: str
    image_col: str | None = None
    mask_col: str | None = None


@dataclass(frozen=True)
class Dataset:
    """Each method gives a new Dataset; nothing runs before an action.

    Filters are all required. Sampling ignores sort; random and seeded samples also ignore the page, of which a limit
    is only their default size. A stratified sample is paged in the order of the id, so that pages are stable.
    """

    source: DataFrame
    profile: Profile
    filters: tuple[tuple[str, Any], ...] = ()
    raw: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()
    order: tuple[tuple[str, str], ...] = ()
    size: int | None = None
    skip: int | None = None
    sampling: Mapping[str, Any] = field(default_factory=dict)

    def filter(self, conditions: Mapping[str, Any] | None = None, **more: Any) -> Dataset:
        """Add conditions, all of which hold; a second value for a key that has plain values makes a list of both.

        Ranges, and a range beside plain values, are held together under ``all``, so that none replaces another.
        """
        held = dict(self.filters)
        for k, v in {**(conditions or {}), **more}.items():
            if k in held and not isinstance(held[k], Mapping) and not isinstance(v, Mapping):
                values = unique([*(held[k] if isinstance(held[k], list) else [held[k]]), *(v if isinstance(v, list | tuple) else [v])])
                held[k] = values if len(values) > 1 else values[0]
            elif k in held:
                parts = lambda x: list(x["all"]) if isinstance(x, Mapping) and set(x) == {"all"} else [list(x) if isinstance(x, tuple) else x]
                held[k] = {"all": [*parts(held[k]), *parts(v)]}
            else:
                held[k] = list(v) if isinstance(v, tuple) else v
        return replace(self, filters=tuple(held.items()))

    def where(self, *expressions: str) -> Dataset:
        return replace(self, raw=(*self.raw, *expressions))

    def select(self, *names: str) -> Dataset:
        return replace(self, columns=(*self.columns, *(n for n in names if n not in self.columns)))

    def sort(self, name: str, direction: str = "asc") -> Dataset:
        direction = direction.lower()
        if direction not in ("asc", "desc"):
            raise ValueError(f"direction is asc or desc, not {direction!r}")
        if name not in self.source.columns:
            raise ValueError(f"no column {name!r}")
        return replace(self, order=(*self.order, (name, direction)))

    def limit(self, n: int) -> Dataset:
        return replace(self, size=n)

    def offset(self, n: int) -> Dataset:
        return replace(self, skip=n)

    def sample_random(self, n: int) -> Dataset:
        return replace(self, sampling={"strategy": "random", "n": n})

    def sample_seeded(self, n: int, seed: int = 42) -> Dataset:
        return replace(self, sampling={"strategy": "seeded", "n": n, "seed": seed})

    def sample_stratified(self, by: list[str], per_group: int, seed: int | None = None) -> Dataset:
        return replace(self, sampling={"strategy": "stratified", "by": list(by), "per_group": per_group, "seed": seed})

    def condition(self) -> Column:
        df = self.source
        return conjunction([*(predicate(df, k, v, self.profile.mask_col) for k, v in self.filters), *map(F.expr, self.raw)])

    def projected(self, df: DataFrame) -> DataFrame:
        if not self.columns:
            return df
        return df.select(self.profile.id_col, *(c for c in self.columns if c != self.profile.id_col))

    def _paged(self, df: DataFrame, order: list[Column]) -> DataFrame:
        if self.size is None and self.skip is None:
            return df
        df = df.orderBy(*order)
        df = df.offset(self.skip) if self.skip else df
        return df if self.size is None else df.limit(self.size)

    def sorting(self) -> list[Column]:
        keys = [F.col(c).asc_nulls_first() if d == "asc" else F.col(c).desc_nulls_last() for c, d in self.order]
        return [*keys, *([] if any(c == self.profile.id_col for c, _ in self.order) else [F.col(self.profile.id_col).asc()])]

    def all(self) -> DataFrame:
        """The rows; a global sort is made only where a page or a sort was asked for."""
        df = self.source.filter(self.condition()) if self.filters or self.raw else self.source
        how, key = self.sampling.get("strategy"), F.col(self.profile.id_col)
        if how == "random":
            return self.projected(df.orderBy(F.rand()).limit(self.sampling.get("n") or self.size or 100))
        if how == "seeded":
            return self.projected(df.orderBy(*seeded_order(key, self.sampling["seed"])).limit(self.sampling.get("n") or self.size or 100))
        if how == "stratified":
            seed = self.sampling.get("seed")
            order = [F.rand()] if seed is None else [md5_key(seed, self.profile.id_col), key]
            return self.projected(self._paged(per_group(df, self.sampling["by"], self.sampling["per_group"], order), [key]))
        if self.order or self.size is not None or self.skip is not None:
            df = self._paged(df, self.sorting()) if self.size is not None or self.skip is not None else df.orderBy(*self.sorting())
        return self.projected(df)

    def count(self) -> int:
        """Rows that pass the filters, whatever else was asked for."""
        return self.source.filter(self.condition()).count()

    def first(self) -> DataFrame:
        return replace(self, size=1).all()

    def preview(self, n: int = 5) -> DataFrame:
        return replace(self, size=min(n, self.size) if self.size is not None else n).all()

    def get(self, record_id: Any) -> DataFrame:
        return Dataset(self.source, self.profile).filter({self.profile.id_col: record_id}).limit(1).all()

    def get_by_image_id(self, image_id: Any) -> DataFrame:
        if not self.profile.image_col:
            raise ValueError(f"{self.profile.name} has no image id")
        return Dataset(self.source, self.profile).filter({self.profile.image_col: image_id}).first()

    def spec(self) -> dict[str, Any]:
        """The query as plain data."""
        return {"profile": self.profile.name, "filters": {k: v for k, v in self.filters}, "raw": list(self.raw), "projection": list(self.columns), "sort": [list(o) for o in self.order], "limit": self.size, "offset": self.skip, "sample": dict(self.sampling)}

    def to_json(self) -> str:
        return json.dumps(self.spec(), sort_keys=True)


def from_spec(source: DataFrame, profile: Profile, spec: Mapping[str, Any] | str) -> Dataset:
    """A Dataset from what ``spec`` or ``to_json`` gave."""
    s = json.loads(spec) if isinstance(spec, str) else spec
    return Dataset(source, profile, tuple((s.get("filters") or {}).items()), tuple(s.get("raw") or ()), tuple(s.get("projection") or ()), tuple((a, b) for a, b in s.get("sort") or ()), s.get("limit"), s.get("offset"), s.get("sample") or {})
