"""A query state: parsed from and written as a URL query, changed step by step, applied to a catalogue DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from urllib.parse import parse_qsl, quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewright.operators import facets, ordering

SORTABLE = ("name", "school", "level", "cost")


def parse_levels(text: str) -> tuple[int, ...]:
    """``1-3,5`` to (1, 2, 3, 5); parts that aren't levels 0 to 9 are dropped."""
    out: set[int] = set()
    for part in text.split(","):
        a, _, b = part.strip().partition("-")
        if a.isdigit() and (b.isdigit() or not b):
            out.update(range(max(0, int(a)), min(9, int(b or a)) + 1))
    return tuple(sorted(out))


def parse_tags(text: str) -> dict[str, str]:
    """``a,-b,!c`` to modes include, exclude, require; of a repeated tag the first counts."""
    out: dict[str, str] = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        mode = {"-": "exclude", "!": "require"}.get(part[0], "include")
        tag = part[mode != "include" :]
        if tag:
            out.setdefault(tag, mode)
    return out


@dataclass(frozen=True)
class QuerySpec:
    text: str = ""
    schools: tuple[str, ...] = ()
    levels: tuple[int, ...] = ()
    tags: dict[str, str] = field(default_factory=dict)
    cap: float | None = None
    sort: str | None = None
    descending: bool = False
    page: int = 1
    page_size: int = 200

    @classmethod
    def parse(cls, query: str, page_size: int = 200) -> QuerySpec:
        """Unknown keys and values are dropped."""
        got = {k.lower(): v for k, v in reversed(parse_qsl(query))}
        sort = got.get("tri", "")
        name = sort.lstrip("-")
        cap, page = got.get("cout", ""), got.get("page", "1")
        return cls(
            text=got.get("q", "").strip(),
            schools=tuple(dict.fromkeys(filter(None, got.get("school", "").split(",")))),
            levels=parse_levels(got.get("niv", "")),
            tags=parse_tags(got.get("tags", "")),
            cap=float(cap) if cap.replace(".", "", 1).isdigit() else None,
            sort=name if name in SORTABLE else None,
            descending=sort.startswith("-") and name in SORTABLE,
            page=max(1, int(page)) if page.isdigit() else 1,
            page_size=page_size,
        )

    def format(self) -> str:
        """Canonical order, defaults left out."""
        mark = {"include": "", "exclude": "-", "require": "!"}
        parts = {
            "q": self.text,
            "school": ",".join(self.schools),
            "niv": ",".join(map(str, self.levels)),
            "tags": ",".join(mark[m] + t for t, m in self.tags.items()),
            "cout": "" if self.cap is None else f"{self.cap:g}",
            "tri": ("-" * self.descending + self.sort) if self.sort else "",
            "page": str(self.page) if self.page > 1 else "",
        }
        return "&".join(f"{k}={quote(v, safe=',!-')}" for k, v in parts.items() if v)

    def cycle_tag(self, tag: str) -> QuerySpec:
        """include, exclude, require, then gone."""
        after = {None: "include", "include": "exclude", "exclude": "require", "require": None}[self.tags.get(tag)]
        tags = {t: m for t, m in self.tags.items() if t != tag} | ({tag: after} if after else {})
        return replace(self, tags=tags, page=1)

    def toggle_sort(self, column: str) -> QuerySpec:
        """Ascending, descending, then none."""
        if self.sort != column:
            return replace(self, sort=column, descending=False)
        return replace(self, sort=None, descending=False) if self.descending else replace(self, descending=True)

    def without(self, name: str) -> QuerySpec:
        return replace(self, **{name: QuerySpec.__dataclass_fields__[name].default if name != "tags" else {}})

    def drill(self, axis: str, value) -> QuerySpec:
        return replace(self, schools=(value,)) if axis == "school" else replace(self, levels=(int(value),)) if axis == "level" else replace(self, tags=self.tags | {value: "require"})

    def active(self) -> list[str]:
        return [n for n in ("text", "schools", "levels", "tags") if getattr(self, n)] + ["cap"] * (self.cap is not None)

    def most_restrictive(self, order: tuple[str, ...] = ("text", "tags", "levels", "schools", "cap")) -> str | None:
        return next((n for n in order if n in self.active()), None)

    def predicate(self):
        of = lambda mode: [t for t, m in self.tags.items() if m == mode]
        out = facets.text_contains(F.col("name"), self.text) & facets.scalar_in(F.col("school"), list(self.schools)) & facets.cost_cap(F.col("cost"), self.cap)
        if self.levels:
            out &= F.col("level").isin(*self.levels)
        if self.tags:
            out &= facets.tri_mode(F.col("tags"), of("include"), of("exclude"), of("require"))
        return out

    def apply(self, rows: DataFrame) -> DataFrame:
        """Filter, order, page. The order ends in name and id, so pages don't overlap."""
        order = (ordering.nulls_last(self.sort, self.descending, "name") if self.sort else [F.col("level").asc_nulls_last(), F.col("name")]) + [F.col("id")]
        return rows.where(self.predicate()).orderBy(*order).offset((self.page - 1) * self.page_size).limit(self.page_size)


def known(text: str, vocabulary: list[str]) -> tuple[str, ...]:
    """The known values of a comma list, in the vocabulary's order; case doesn't matter."""
    asked = {p.strip().lower() for p in text.split(",")}
    return tuple(v for v in vocabulary if v.lower() in asked)


@dataclass(frozen=True)
class FacetSpec:
    """State of a catalogue with facets of one kind: each facet includes or excludes values. facets: name to vocabulary."""

    facets: dict[str, list[str]]
    text: str = ""
    include: dict[str, tuple[str, ...]] = field(default_factory=dict)
    exclude: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @classmethod
    def parse(cls, query: str, facets: dict[str, list[str]]) -> FacetSpec:
        """``name=a,-b``; unknown facets and values are dropped."""
        got = {k.lower(): v for k, v in reversed(parse_qsl(query))}
        modes = {n: parse_tags(got.get(n, "")) for n in facets}
        of = lambda mode: {n: v for n, m in modes.items() if (v := known(",".join(t for t, x in m.items() if x == mode), facets[n]))}
        return cls(facets, got.get("q", "").strip(), of("include"), of("exclude"))

    def format(self) -> str:
        parts = {"q": self.text} | {n: ",".join([*self.include.get(n, ()), *("-" + v for v in self.exclude.get(n, ()))]) for n in self.facets}
        return "&".join(f"{k}={quote(v, safe=',!-')}" for k, v in parts.items() if v)

    def predicate(self, arrays: set[str] = frozenset()):
        """arrays: facets whose column is an array."""
        out = facets.text_contains(F.col("name"), self.text)
        for n in self.facets:
            values = F.col(n) if n in arrays else F.array_compact(F.array(n))
            out &= facets.tri_mode(values, list(self.include.get(n, ())), list(self.exclude.get(n, ())))
        return out


AXES = ("level", "school", "save", "range", "component", "tag")


@dataclass(frozen=True)
class ExplorationSpec:
    """State of an exploration: a first class and more of them, values drilled into by axis, and the axis that is shown."""

    classes: tuple[str, ...] = ()
    drilled: dict[str, str] = field(default_factory=dict)
    axis: str | None = None

    @classmethod
    def parse(cls, query: str, classes: list[str], vocabularies: dict[str, list[str]]) -> ExplorationSpec:
        """``classe`` is the first class, ``avec`` the others; an axis keeps a known value only."""
        got = {k.lower(): v for k, v in reversed(parse_qsl(query))}
        first = known(got.get("classe", ""), classes)[:1]
        more = tuple(c for c in known(got.get("avec", ""), classes) if c not in first) if first else ()
        drilled = {a: v[0] for a in AXES if (v := known(got.get(a, ""), vocabularies.get(a, [])))}
        axis = got.get("axe", "")
        return cls(first + more, drilled, axis if axis in AXES and axis not in drilled else None)

    def format(self) -> str:
        parts = {"classe": ",".join(self.classes[:1]), "avec": ",".join(self.classes[1:])} | {a: self.drilled.get(a, "") for a in AXES} | {"axe": self.axis or ""}
        return "&".join(f"{k}={quote(v, safe=',!-')}" for k, v in parts.items() if v)

    def available(self, vocabularies: dict[str, list[str]]) -> list[str]:
        """Axes that have values and aren't drilled into."""
        return [a for a in AXES if vocabularies.get(a) and a not in self.drilled]

    def drill(self, axis: str, value: str) -> ExplorationSpec:
        return replace(self, drilled=self.drilled | {axis: value}, axis=None)

    def up(self) -> ExplorationSpec:
        """Without the axis that was drilled into last."""
        return replace(self, drilled=dict(list(self.drilled.items())[:-1]))

    def predicate(self, columns: dict[str, tuple[str, bool]], levels: str = "levels", without: str | None = None):
        """Rows of any of the classes with the drilled values; columns: axis to (column, whether it is an array), levels: the
        column of the map of class to level. A chart of an axis leaves that axis out."""
        out = F.lit(True)
        if self.classes:
            wanted = [int(self.drilled["level"])] if "level" in self.drilled and without != "level" else []
            out &= facets.level_of_any(F.col(levels), list(self.classes), wanted)
        for axis, value in self.drilled.items():
            if axis in (without, "level"):
                continue
            column, many = columns[axis]
            out &= F.coalesce(F.array_contains(column, value) if many else F.col(column) == value, F.lit(False))
        return out


@dataclass(frozen=True)
class ComparisonSpec:
    """State of a comparison: at most three classes, a mode, and a column to sort by."""

    classes: tuple[str, ...] = ()
    mode: str = "all"
    sort: str | None = None
    descending: bool = False

    MODES = ("all", "shared", "exclusive")
    MOST = 3

    @classmethod
    def parse(cls, query: str, classes: list[str]) -> ComparisonSpec:
        """Classes keep the order they are named in; a column of a class that isn't compared is dropped."""
        got = {k.lower(): v for k, v in reversed(parse_qsl(query))}
        named = [c for p in got.get("classes", "").split(",") for c in known(p, classes)]
        chosen = tuple(dict.fromkeys(named))[: cls.MOST]
        sort, mode = got.get("tri", ""), got.get("mode", "all")
        name = sort.lstrip("-")
        valid = name in ("name", "school", "gap") or name.partition(":")[0] == "level" and name.partition(":")[2] in chosen
        return cls(chosen, mode if mode in cls.MODES else "all", name if valid else None, sort.startswith("-") and valid)

    def format(self) -> str:
        parts = {"classes": ",".join(self.classes), "mode": self.mode if self.mode != "all" else "", "tri": ("-" * self.descending + self.sort) if self.sort else ""}
        return "&".join(f"{k}={quote(v, safe=',!-:')}" for k, v in parts.items() if v)

    def order(self) -> list:
        """Nulls last both ways, names break ties; a level is that of the map column ``levels``."""
        if self.sort is None:
            return [F.col("name"), F.col("id")]
        c = F.try_element_at("levels", F.lit(self.sort.partition(":")[2])) if self.sort.startswith("level:") else F.col(self.sort)
        return [c.desc_nulls_last() if self.descending else c.asc_nulls_last(), F.col("name"), F.col("id")]


def grouped(values: list[str], headings: dict[str, list[str]], rest: str) -> dict[str, list[str]]:
    """Values under the first heading that lists them, in its order; the others last, in their own."""
    out = {h: [v for v in listed if v in values] for h, listed in headings.items()}
    told = {v for vs in out.values() for v in vs}
    out[rest] = [v for v in values if v not in told]
    return {h: vs for h, vs in out.items() if vs}

