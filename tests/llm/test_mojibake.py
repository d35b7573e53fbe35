import pytest

from loomcast.llm import mojibake as M

CLEAN = [
    "The history of tape machines – with Dralim", "“the rules of bee gardens” — Radio Osworgos", "MANHÃ EM Vãba: a canção dos coros", "«le café…» – Radio", "ÂGE D’OR", "¡olé!", "Þórr", "½ h",
    "Die Bräuronschö-Stunde: das Geräusch", "Студия Тормаукел", "«потерянный архив» – Радио Фенпил", "主播岚砾", "【稻岭工作室】夜行列车的安静的一面（71）", "ドニリリの部屋：石窯の歴史", "語り手カギギハ", "ｶﾀｶﾅ™", "Радио №12 → β", "",
]

TEXTS = ["Estação Pilkacor – “a língua”", "Théâtre Létham à l’écoute", "Büro Ronrustor für Hörbücher", "棋社的价格｜对谈浦苇的声音", "語り手ゾヨロロの部屋の不思議な文法", "Заметки про ремонт уличных пекарей"]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts_stay(text):
    assert M.repair(text) == (False, None, "")


@pytest.mark.parametrize("codec", ["latin-1", "cp1252", "cp1250", "cp437", "mac_roman"])
@pytest.mark.parametrize("text", TEXTS)
def test_utf8_read_in_a_single_byte_page(text, codec):
    seen = "".join(M.chars_of(codec).get(b, chr(b)) if b > 127 else chr(b) for b in text.encode())
    damaged, restored, _ = M.repair(seen)
    assert damaged and restored == text


def test_twice_damaged():
    once = "Hörbücher".encode().decode("cp1252")
    assert M.repair(once.encode().decode("cp1252"))[:2] == (True, "Hörbücher")


@pytest.mark.parametrize("true,text", [("gbk", "榆泉工作室的价格"), ("cp932", "語り手カギギハの部屋"), ("euc_jp", "語り手カギギハの部屋"), ("gbk", "リベヴェ制作室"), ("gbk", "《老水磨坊的天气》Radio Hobpex"), ("gbk", "渡砾与岚渡稻"), ("cp1251", "Радио Линдра язык печей")])
def test_legacy_read_as_western(true, text):
    damaged, restored, _ = M.repair(text.encode(true).decode("latin-1"))
    assert damaged and restored == text


def test_apostrophes_of_english_names(spark, sf):
    from loomcast.session import table

    letters = M.letters_of(table(spark, sf, "lang_samples"))
    for text in ("Smithís memoir", "Smithís notes", "The memoir of Harrisonís youngest brother", "Walkerís garden and the history of it"):
        assert M.repair(text, letters)[:2] == (True, text.replace("í", "’")), text
    for text in ("El País de las maravillas", "París en la tarde: historia de una canción", "Luís e a história dos moinhos", "Moisés y la música"):
        assert M.repair(text, letters) == (False, None, ""), text
    assert M.repair("Smithís memoir")[0] is False


def test_damage_of_any_depth():
    text = seen = "Hörbücher für alle"
    for _ in range(8):
        seen = seen.encode().decode("latin-1")
    assert M.repair(seen)[:2] == (True, text)


def test_east_asian_mixes_and_lost_characters():
    assert M.repair("主播藤霁的工作".encode().decode("gbk", "replace"))[0]
    assert M.repair("Caf� Collective") == (True, None, "")
    assert M.repair("ThÈ‚tre Torwenvel")[1] == "Théâtre Torwenvel"


def test_only_the_span_is_decoded():
    assert M.repair("MANHÃ EM Vim: a previsÃ£o")[1] == "MANHÃ EM Vim: a previsão"


def test_damage_among_legitimate_accents():
    clean = "La canción de los niños: información, educación, música, árbol, útil, razón y corazón – línea"
    assert M.repair(clean)[0] is False and M.repair(clean.replace("–", "–".encode().decode("cp1252")))[:2] == (True, clean)


def test_very_long_text_and_table(spark):
    assert M.repair("naïve text " * 5000 + "CafÃ© " * 5000)[1] == "naïve text " * 5000 + "Café " * 5000
    rows = [(1, "CafÃ©", None, "x"), (1, "CafÃ©", None, "x"), (None, None, "NÃ´m", "y"), (2, "", " ", "z")]
    df = spark.createDataFrame(rows, "id long, title string, author string, field_name string")
    got = sorted((r.id or 0, r.field_name, r.restored_text) for r in M.find_damaged(df, ["title", "author"]).collect())
    assert got == [(0, "author", "Nôm"), (1, "title", "Café"), (1, "title", "Café")]
    assert M.find_damaged(df.where("false"), ["title"]).count() == 0
