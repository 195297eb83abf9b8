"""Slugs by templates: one table tells how pages are addressed, from when to when; patterns, parts and candidates come from it."""

from __future__ import annotations

import re
from typing import NamedTuple

#: field of a template -> what it matches
FIELDS: dict[str, str] = {"year": "[0-9]{4}", "number": "[0-9]+", "serial": "[0-9]+", "day": "[0-9]{2}[a-z]{3}[0-9]{4}", "code": "[a-z]{2}", "tail": ".*"}
_FIELD = re.compile(r"\{(\w+)\}")


class SlugRule(NamedTuple):
    """A form of slugs: its name, template, the years it was used in, and whether it is worth a try in any year."""

    name: str
    template: str
    since: int
    until: int
    always: bool = False

    def fields(self) -> list[str]:
        return _FIELD.findall(self.template)

    def pattern(self) -> str:
        """The template as a pattern of a whole slug, a group a field."""
        parts = _FIELD.split(self.template)
        return "^" + "".join(f"({FIELDS[p]})" if i % 2 else p.replace(".", "[.]") for i, p in enumerate(parts)) + "$"

    def group(self, field: str) -> int:
        """The number of a field's group, 0 for none."""
        return self.fields().index(field) + 1 if field in self.fields() else 0

    def filled(self, **columns: str) -> str:
        """SQL that puts columns into the template; a tail is left out."""
        parts = _FIELD.split(self.template)
        items = [columns[p] if i % 2 else f"'{p}'" for i, p in enumerate(parts) if p and not (i % 2 and p == "tail")]
        return " || ".join(items)


#: this library's own: how its example pages are addressed, in the order the forms are tried
RULES: tuple[SlugRule, ...] = (
    SlugRule("current", "act-{number}-{year}{tail}", 2019, 2099, always=True),
    SlugRule("serial", "act-{number}-n{serial}-{year}{tail}", 2022, 2099),
    SlugRule("short", "a{number}.{year}", 2016, 2021),
    SlugRule("year-first", "{year}-act-{number}{tail}", 2012, 2018, always=True),
    SlugRule("coded", "{year}-{code}{number}{tail}", 2008, 2013),
    SlugRule("daily", "{day}-item{number}{tail}", 2005, 2009),
    SlugRule("folder", "vol{year}.p{number}{tail}", 2005, 2011),
)
