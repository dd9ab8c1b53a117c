"""A graph of lookups that plans only the joins that the asked columns need.

Catalyst keeps every left join whose key it does not know to be unique, so a
wide view over forty lookups pays for all of them, whatever a query selects.
Here each table's outputs and links are data.  Asking an entity for columns
walks the links they need, joins those and no others, and asks the linked
entities only for the columns in question.

A lookup that nothing asked for is left out only if its key is declared
unique, for then it cannot change the number of rows.  One whose key may
repeat (several addresses of a site, several officers of a user) multiplies
rows, so it is joined in any case; so is an inner link, which drops rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    """An output column made of others: columns of the entity's own table, or
    ``link.column`` of a linked one."""

    needs: tuple[str, ...]
    make: Callable[..., Column]


def same(name: str) -> Field:
    return Field((name,), lambda c: c)


def text(name: str) -> Field:
    """A descriptive column: null becomes an empty text."""
    return Field((name,), lambda c: F.coalesce(c, F.lit("")))


def first_of(*names: str, default: str | None = None) -> Field:
    return Field(names, lambda *c: F.coalesce(*c, *([] if default is None else [F.lit(default)])))


@dataclass(frozen=True)
class Link:
    """A join to another entity (or plain table) where its ``key`` equals
    ``on``, a column, a ``link.column`` or a computed key.  ``only`` is a
    condition on the right side; it belongs to the join, so rows without a
    match stay."""

    to: str
    on: str | Field
    key: str = "id"
    only: Callable[[], Column] | None = None
    how: str = "left"

    def on_field(self) -> Field:
        return self.on if isinstance(self.on, Field) else same(self.on)


@dataclass(frozen=True)
class Entity:
    """A table with its computed outputs and links.  Columns of the table are
    outputs as they are."""

    table: str
    fields: Mapping[str, Field] = field(default_factory=dict)
    links: Mapping[str, Link] = field(default_factory=dict)


class Graph:
    def __init__(self, entities: Mapping[str, Entity]):
        self.entities = dict(entities)

    def entity(self, name: str) -> Entity:
        return self.entities.get(name) or Entity(name)

    def extended(self, name: str, fields: Mapping[str, Field] | None = None, links: Mapping[str, Link] | None = None) -> Graph:
        """This graph with more or other fields and links of one entity."""
        e = self.entity(name)
        new = replace(e, fields={**e.fields, **(fields or {})}, links={**e.links, **(links or {})})
        return Graph({**self.entities, name: new})

    def table_of(self, link: Link) -> str:
        return self.entity(link.to).table

    def may_repeat(self, link: Link, unique: Iterable[str]) -> bool:
        """Whether the link can give several rows for one."""
        return f"{self.table_of(link)}.{link.key}" not in unique or any(
            self.may_repeat(inner, unique) for inner in self.entity(link.to).links.values())

    def needed(self, name: str, columns: Iterable[str], unique: Iterable[str]) -> dict[str, set[str]]:
        """The entity's own links to join for these columns, in order, each
        with the columns asked of it."""
        e = self.entity(name)
        asked: dict[str, set[str]] = {}
        for c in columns:
            for n in e.fields.get(c, same(c)).needs:
                if "." in n:
                    link, col = n.split(".", 1)
                    asked.setdefault(link, set()).add(col)
        for l, link in e.links.items():
            if link.how != "left" or self.may_repeat(link, unique):
                asked.setdefault(l, set())
        todo = list(asked)
        while todo:
            for n in e.links[todo.pop()].on_field().needs:
                if "." in n:
                    link, col = n.split(".", 1)
                    if link not in asked:
                        todo.append(link)
                    asked.setdefault(link, set()).add(col)
        done: dict[str, set[str]] = {}
        while len(done) < len(asked):  # a link comes after those that its key needs
            ready = [l for l in e.links if l in asked and l not in done
                     and all("." not in n or n.split(".", 1)[0] in done for n in e.links[l].on_field().needs)]
            if not ready:
                raise ValueError(f"links of {name} without a table or in a circle: {sorted(set(asked) - set(done))}")
            done[ready[0]] = asked[ready[0]]
        return done

    def plan(self, tables: Mapping[str, DataFrame], name: str, columns: Iterable[str], unique: Iterable[str] = (),
             only: Callable[[], Column] | None = None, key: str | None = None) -> DataFrame:
        """The entity's ``columns`` over ``tables``; with ``key``, that
        column of its table besides, as ``_key``."""
        e, columns, unique = self.entity(name), list(columns), frozenset(unique)
        df = tables[e.table]
        if only is not None:
            df = df.where(only())

        def column(path: str) -> Column:
            return F.col(f"_{path.replace('.', '__')}" if "." in path else path)

        for l, asked in self.needed(name, columns, unique).items():
            link = e.links[l]
            right = self.plan(tables, link.to, sorted(asked), unique, link.only, link.key)
            right = right.withColumnsRenamed({c: f"_{l}__{c}" for c in asked} | {"_key": f"_{l}__key"})
            on = link.on_field()
            df = df.join(right, on.make(*map(column, on.needs)) == F.col(f"_{l}__key"), link.how)
        out = []
        for c in columns:
            f = e.fields.get(c, same(c))
            out.append(f.make(*map(column, f.needs)).alias(c))
        return df.select(*out, *([F.col(key).alias("_key")] if key else []))
