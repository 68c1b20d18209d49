"""Script conversion by dictionary and spacing between Han and half-width text."""

from __future__ import annotations

import re
from collections.abc import Iterable

from quern.functions.rules import Rules

#: A small seed of (simplified, traditional of Taiwan). Production runs read full dictionaries from a table.
SEED = (
    ("软件", "軟體"), ("硬件", "硬體"), ("网络", "網路"), ("信息", "資訊"), ("程序", "程式"), ("视频", "影片"), ("计算机", "電腦"), ("数据库", "資料庫"), ("打印机", "印表機"), ("鼠标", "滑鼠"),
    ("历史", "歷史"), ("国家", "國家"), ("语言", "語言"), ("数学", "數學"), ("图书馆", "圖書館"), ("头发", "頭髮"), ("发展", "發展"), ("后来", "後來"), ("皇后", "皇后"), ("里面", "裡面"),
    ("国", "國"), ("学", "學"), ("语", "語"), ("汉", "漢"), ("书", "書"), ("车", "車"), ("马", "馬"), ("门", "門"), ("电", "電"), ("东", "東"), ("长", "長"), ("见", "見"), ("时", "時"), ("间", "間"), ("发", "發"),
    ("会", "會"), ("体", "體"), ("万", "萬"), ("与", "與"), ("为", "為"), ("这", "這"), ("个", "個"), ("们", "們"), ("说", "說"), ("来", "來"), ("对", "對"), ("后", "後"), ("里", "裡"), ("历", "歷"), ("数", "數"),
)


class Converter:
    """Longest match from the left over a phrase dictionary."""

    def __init__(self, pairs: Iterable[tuple[str, str]]):
        self.to: dict[str, str] = {}
        for source, target in pairs:
            self.to.setdefault(source, target)
        keys = sorted((k for k in self.to if k), key=len, reverse=True)
        self.pattern = re.compile("|".join(map(re.escape, keys))) if keys else None

    def __call__(self, text: str) -> str:
        return self.pattern.sub(lambda m: self.to[m.group()], text) if self.pattern else text


def read_pairs(paths: list[str]) -> list[tuple[str, str]]:
    """Pairs of dictionary files: on each line a phrase, a tab and what it becomes, of which the first of several
    words counts. Blank lines and lines that start with # are skipped. Of one phrase the first pair holds."""
    pairs = []
    for path in paths:
        with open(path, encoding="utf-8-sig") as lines:
            for line in lines:
                source, tab, target = line.rstrip("\n").partition("\t")
                if tab and source and not line.startswith("#"):
                    pairs.append((source, (target.split() or [""])[0]))
    return pairs


def seed(direction: str) -> Converter:
    """``tw``: to traditional, ``cn``: to simplified."""
    if direction not in ("tw", "cn"):
        raise ValueError("direction is tw or cn")
    return Converter(SEED if direction == "tw" else [(b, a) for a, b in SEED])


_CJK = "⺀-⻿⼀-⿟぀-ゟ゠-ヺー-ヿ㄀-ㄯ㈀-㋿㐀-䶿一-鿿豈-﫿"
_HALF = r"A-Za-z0-9`$%^&*\-=+\\|/@#"
_SPACING = Rules(
    (rf"([{_CJK}])([\"'])", r"\1 \2"),
    (rf"([\"'])([{_CJK}])", r"\1 \2"),
    (r"([\"'])\s*(.+?)\s*([\"'])", r"\1\2\3"),
    (rf"([{_CJK}])([+\-*/=&\\|<>])([A-Za-z0-9])", r"\1 \2 \3"),
    (rf"([A-Za-z0-9])([+\-*/=&\\|<>])([{_CJK}])", r"\1 \2 \3"),
    (rf"([{_CJK}])([(\[{{<]+)", r"\1 \2"),
    (rf"([)\]}}>]+)([{_CJK}])", r"\1 \2"),
    # a half-width character after one that is not; what starts with the rarer is scanned fastest
    (rf"([{_HALF}])(?<=[{_CJK}][{_HALF}])", r" \1"),
    (rf"([A-Za-z0-9`~$%^&*\-=+\\|/!;:,.?])([{_CJK}])", r"\1 \2"),
)
_HAS_CJK = re.compile(f"[{_CJK}]")


def space_scripts(text: str) -> str:
    """One space between Han, kana or bopomofo and half-width letters, digits and symbols."""
    return text if len(text) < 2 or not _HAS_CJK.search(text) else _SPACING(text)
