"""Lists without repeats, and repeats within scripts without spaces."""

from hypothesis import given, settings
from hypothesis import strategies as st

from quaystone.llm import stuffing

TAGS = "leather wallet, phone case, usb charger, garden hose, desk lamp, wool scarf, tea pot, bike pump, rain coat, oak table, steel pan, glass jar, silk tie, toy train, bread knife, door mat, paper fan, wall clock, sun hat, ear plug, copper wire, plant pot, wine rack, bath towel, snow boot, coin purse, hair dryer, fish tank, book shelf, fire alarm"
PROSE = "The dispatcher checked the meter before dawn and wrote the reading into the ledger, the report, the summary, and the log. Nobody knew why the load had stopped, so the analyst called the base."
HAN = "昨天晚上下了一场大雨，河边的小路被水淹没了。早晨邻居们带着工具出来清理，孩子们在旁边帮忙。到了中午，太阳出来以后，大家坐在树下喝茶聊天。"


def test_lists_of_unlike_items_are_filler():
    for text in (TAGS, TAGS + ".", TAGS.replace(", ", "\n"), TAGS.replace(", ", " | "), PROSE + "\n" + TAGS):
        assert stuffing.filler_share(text)[0] > 0.5, text[:60]


def test_repeats_in_scripts_without_spaces():
    share, covered = stuffing.filler_share("真皮钱包手机壳充电器真皮钱包手机壳数据线真皮钱包手机壳充电器雨衣真皮钱包手机壳充电器")
    assert share == 1 and covered > 0.8
    assert stuffing.filler_share("雨衣 出租 手机 雨衣 手机 出租 出租 雨衣 手机")[1] == 1
    assert stuffing.filler_share(HAN)[0] == 0


def test_sentences_with_lists_are_no_case():
    poem = "\n".join(["the rain on the road", "is it the night", "or only the wind", "that was at the door"] * 1 + ["she is at sea", "and he is home", "we had no lamp", "but the moon was", "it is not far", "to the old mill", "where they had been", "in the long grass", "by the low wall"])
    for text in (PROSE, poem, PROSE * 2 + "\n" + "\n".join(TAGS.split(", ")[:14]), "Anna, Ben, Clara, and Dora took the cab to the harbour, paid in cash, and left.", HAN.replace("，", ",")):
        assert stuffing.filler_share(text)[0] < 0.5, text[:60]


def test_tables_logs_and_code_are_no_case():
    stations = "\n".join(f"{a}{b} {i * 7 % 90 + 10} {i * 3.5}" for i, (a, b) in enumerate((a, b) for a in ("Elm", "Oak", "Fen", "Ald", "Kes", "Mer") for b in ("wick", "ham", "port", "ley")))
    log = "\n".join(f"{6 + i // 4:02d}:{i % 4 * 15:02d} {x}" for i, x in enumerate(["left depot", "stand full", "rider picked up", "rank empty", "refuelled", "rider dropped", "short break", "meter reset"] * 3))
    code = "\n".join(["def total(rows):", "    out = {}", "    for r in rows:", "        out[r['zone']] = out.get(r['zone'], 0) + r['fare']", "    return out", "print(total([{'zone': 1, 'fare': 2.5}]))", "x = total(rows)", "y = {k: v for k, v in x.items()}"])
    for text in (stations, stations.replace(" ", " | "), log, code):
        assert stuffing.filler_share(text)[0] <= 0.5, text[:60]


def test_a_run_of_words_that_nothing_ties_is_filler():
    names = " ".join(x for x in TAGS.split(", ")[:23])
    assert stuffing.filler_share(names)[0] > 0.5 and stuffing.filler_share(PROSE + " " + PROSE + "\n" + names)[0] < 0.5


def test_a_page_below_the_bar_needs_no_automaton(monkeypatch):
    monkeypatch.setattr(stuffing, "repeats", None)
    share, covered = stuffing.filler_share(PROSE, 0.5, False)
    assert share <= 0.5 and covered is None and stuffing.filler_share("  ", 0.5, False) == (0.0, 0.0)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*PROSE.split(), *TAGS.split(), "\n", "|", "https://a.example/b", ".", "12:30", HAN[:9]]), max_size=60))
def test_the_bound_holds(words):
    text = " ".join(words)
    most, covered = stuffing.filler_share(text, 0.5, False)
    exact = stuffing.filler_share(text, -1.0)
    assert stuffing.filler_share(text, 1.0) == exact  # windows cover what repeats cover
    assert (exact[0] <= most and exact[0] <= 0.5) if covered is None and text.strip() else (most, covered) == exact
