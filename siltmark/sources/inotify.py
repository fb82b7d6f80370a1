"""Directories that change, by the Linux kernel's inotify; no library beyond libc."""

from __future__ import annotations

import ctypes
import os
import select
import struct

#: Bits of linux/inotify.h.
ATTRIB, CLOSE_WRITE, MOVED_FROM, MOVED_TO, CREATE, DELETE, DELETE_SELF, MOVE_SELF, Q_OVERFLOW, IGNORED, ONLYDIR, DONT_FOLLOW, ISDIR = 0x4, 0x8, 0x40, 0x80, 0x100, 0x200, 0x400, 0x800, 0x4000, 0x8000, 0x1000000, 0x2000000, 0x40000000
WATCHED = ATTRIB | CLOSE_WRITE | MOVED_FROM | MOVED_TO | CREATE | DELETE | DELETE_SELF | MOVE_SELF | ONLYDIR | DONT_FOLLOW
_HEAD = struct.Struct("iIII")


class Watcher:
    """Watches a tree's directories. OSError where the kernel has no inotify, or no more watches to give."""

    def __init__(self, root: str):
        self.root = root
        self._libc = ctypes.CDLL(None, use_errno=True)
        if not hasattr(self._libc, "inotify_init1"):
            raise OSError("no inotify")
        self._fd = self._libc.inotify_init1(os.O_NONBLOCK | os.O_CLOEXEC)
        if self._fd < 0:
            raise OSError(ctypes.get_errno(), "inotify_init1")
        self._watches: dict[int, str] = {}
        try:
            self._add_tree("")
        except OSError:
            self.close()
            raise

    def _add(self, top: str) -> None:
        path = os.path.join(self.root, top) if top else self.root
        number = self._libc.inotify_add_watch(self._fd, os.fsencode(path), WATCHED)
        if number < 0:
            code = ctypes.get_errno()
            if code in (2, 20):  # it has gone, or become a file, meanwhile
                return
            raise OSError(code, os.strerror(code), path)
        self._watches[number] = top

    def _add_tree(self, top: str) -> list[str]:
        """Watches a directory and all below it; each is watched before it is looked into."""
        found, todo = [], [top]
        while todo:
            at = todo.pop()
            self._add(at)
            found.append(at)
            try:
                entries = list(os.scandir(os.path.join(self.root, at) if at else self.root))
            except OSError:
                continue
            todo += [f"{at}/{e.name}" if at else e.name for e in entries if e.is_dir(follow_symlinks=False)]
        return found

    def wait(self, seconds: float) -> set[str] | None:
        """The directories (relative to the root) in which something changed, new ones among them; empty if nothing did in that time, None if so much did that all must be looked at."""
        if not select.select([self._fd], [], [], max(0.0, seconds))[0]:
            return set()
        data, dirty, lost = os.read(self._fd, 1 << 16), set(), False
        at = 0
        while at < len(data):
            number, mask, _, length = _HEAD.unpack_from(data, at)
            name = os.fsdecode(data[at + _HEAD.size : at + _HEAD.size + length].rstrip(b"\0"))
            at += _HEAD.size + length
            if mask & Q_OVERFLOW:
                lost = True
                continue
            if mask & IGNORED:
                self._watches.pop(number, None)
                continue
            top = self._watches.get(number)
            if top is None:
                continue
            dirty.add(top)
            if mask & ISDIR and mask & (CREATE | MOVED_TO):
                dirty.update(self._add_tree(f"{top}/{name}" if top else name))
            elif mask & ISDIR and mask & MOVED_FROM:
                self._forget(f"{top}/{name}" if top else name)
        if lost:
            self._add_tree("")
            return None
        return dirty

    def _forget(self, top: str) -> None:
        """Ends the watches of a directory that has left its place; where it came from is dirty already."""
        for number in [n for n, p in self._watches.items() if p == top or p.startswith(top + "/")]:
            self._libc.inotify_rm_watch(self._fd, number)
            del self._watches[number]

    def close(self) -> None:
        if self._fd >= 0:
            os.close(self._fd)
            self._fd = -1
