"""A bounded memory of what was computed for strings, for the workers of a task."""

from __future__ import annotations

from collections.abc import Callable, Iterable


class Remembered(dict):
    """Numbers of strings, and ``columns`` values (bytes or None) for each number, computed once for all strings that are new.

    A string that ``parts`` takes apart gets the values of its two parts, one after the other, and is not computed.

    Two generations are kept, each of about ``most`` strings: when the younger one is full it becomes the older one, from
    which strings that come again are taken over, so that frequent ones stay and rare ones go.
    """

    def __init__(
        self, compute: Callable[[list[str]], Iterable[tuple]], most: int, parts: Callable[[str], tuple[str, str] | None], columns: int = 1, call: int = 8192
    ):
        self.compute, self.most, self.parts, self.call = compute, most, parts, call
        self.found: list[list] = [[] for _ in range(columns)]
        self.older: dict[str, int] = {}
        self.older_found = self.found
        self.new: list[str] = []
        self.joined: list[tuple[int, int, int]] = []

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self.found[0])
        before = self.older.get(key)
        for column, older in zip(self.found, self.older_found):
            column.append(None if before is None else older[before])
        if before is None:
            two = self.parts(key)
            if two:
                self.joined.append((number, self[two[0]], self[two[1]]))
            else:
                self.new.append(key)
        return number

    def numbers_of(self, parts: list[list[str]]) -> list[list[int]]:
        """The numbers of the strings of each part, into the lists ``found``; they hold until the next call."""
        if len(self) > self.most:
            self.older, self.older_found = dict(self), self.found
            self.clear()
            self.found = [[] for _ in self.found]
        numbers = [list(map(self.__getitem__, part)) for part in parts]
        for i in range(0, len(self.new), self.call):
            new = self.new[i : i + self.call]
            for key, values in zip(new, self.compute(new)):
                number = self[key]
                for column, value in zip(self.found, values):
                    column[number] = value
        for column in self.found:
            for number, first, second in self.joined:
                a, b = column[first], column[second]
                column[number] = None if a is None or b is None else a + b
        self.new, self.joined = [], []
        return numbers
