"""Element selection as Catalyst expressions over shredded pages.

A job declares the elements it cares about as ``Marks``. The shred pass checks
each declaration while the page's open elements are at hand, and stores the
outcome in bit masks; the methods here turn a mark name into a Column over the
node arrays. Descendant scoping costs one bit test per node.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mark:
    """Which elements get a mark, and what to keep of them.

    ``inside``: some element around it has that mark; ``child_of``: its parent
    has it. ``text`` lists the text to keep: ``own`` (text nodes directly below,
    in ``texts``), ``first`` and ``deep`` (first / all text nodes below, in the
    element). ``scope`` marks serve other marks only and are not kept.
    """

    tag: str | None = None
    id: str | None = None
    cls: str | None = None
    where: tuple[tuple[str, str], ...] = ()
    inside: str | None = None
    child_of: str | None = None
    text: str = ""
    attrs: tuple[str, ...] = ()
    href: bool = False
    scope: bool = False


class Marks:
    """A named set of up to 63 marks; each may refer to the ones before it."""

    def __init__(self, **marks: Mark) -> None:
        if len(marks) > 63:
            raise ValueError("at most 63 marks fit in the mask")
        self.marks = marks
        self.bit = {name: 1 << k for k, name in enumerate(marks)}
        seen: set[str] = set()
        for name, mark in marks.items():
            for ref in (mark.inside, mark.child_of):
                if ref is not None and ref not in seen:
                    raise ValueError(f"mark {name!r} refers to {ref!r}, which is not declared before it")
            seen.add(name)

    def below(self, root: str) -> int:
        """Mask of ``root`` and every mark whose scope chain leads to it."""
        mask = self.bit[root]
        for name, mark in self.marks.items():
            for ref in (mark.inside, mark.child_of):
                if ref is not None and mask & self.bit[ref]:
                    mask |= self.bit[name]
        return mask

    def compiled(self):
        """Plain tuples for the shred pass."""
        by_tag: dict[str, list] = {}
        any_tag: list = []
        shown = own = first = deep = resolved = 0
        kept = []
        for name, m in self.marks.items():
            bit = self.bit[name]
            row = (bit, m.id, m.cls, m.where,
                   self.bit[m.inside] if m.inside else 0,
                   self.bit[m.child_of] if m.child_of else 0)
            (any_tag if m.tag is None else by_tag.setdefault(m.tag, [])).append(row)
            kinds = m.text.split()
            own |= bit if "own" in kinds else 0
            first |= bit if "first" in kinds else 0
            deep |= bit if "deep" in kinds else 0
            resolved |= bit if m.href else 0
            shown |= 0 if m.scope else bit
            if m.attrs:
                kept.append((bit, m.attrs))
        for rows in by_tag.values():
            rows.extend(any_tag)
        return by_tag, any_tag, shown, own, first, deep, kept, resolved

    def mask(self, *names: str) -> int:
        mask = 0
        for name in names:
            mask |= self.bit[name]
        return mask

    # ---- Columns -------------------------------------------------------------
    def els(self, *names: str) -> Column:
        """Elements with any of the marks, each once, in document order."""
        mask = F.lit(self.mask(*names)).cast("long")
        return F.filter("els", lambda x: x["own"].bitwiseAND(mask) != 0)

    def count(self, *names: str) -> Column:
        return F.size(self.els(*names))

    def has(self, *names: str) -> Column:
        mask = F.lit(self.mask(*names)).cast("long")
        return F.exists("els", lambda x: x["own"].bitwiseAND(mask) != 0)

    def texts(self, *names: str) -> Column:
        """Own text nodes of the marked elements, in document order."""
        mask = F.lit(self.mask(*names)).cast("long")
        return F.transform(F.filter("texts", lambda t: t["own"].bitwiseAND(mask) != 0),
                           lambda t: t["s"])

    def attr(self, name: str, attribute: str) -> Column:
        """Values of an attribute; elements that lack it are left out."""
        return F.filter(F.transform(self.els(name), lambda x: x["attrs"][attribute]),
                        lambda v: v.isNotNull())


def first_or(values: Column, default: str | None = "") -> Column:
    """The first entry, or the default when there is none."""
    first = F.get(values, F.lit(0))
    return first if default is None else F.coalesce(first, F.lit(default))


def non_blank(values: Column) -> Column:
    return F.filter(values, lambda s: s != "")


def within(nodes: Column, scope: Column) -> Column:
    """Nodes inside one element, by position interval."""
    return F.filter(nodes, lambda x: (x["i"] > scope["i"]) & (x["i"] <= scope["last"]))
