import random
import re
from collections import Counter

import public_tokenizers as P

from parcelpulse.llm import quality

PIECES = P.path("piece_bpe_32k.model")
CLEAN = "The old harbour lies behind two hills, and ships from many lands still call there every spring to trade salt for wool."


def _brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in lines
            lines.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_measures_like_brute_force(docs):
    random.seed(0)
    parts = ["a", "b", " ", "\n", "c d ", "\xa0", "|", "é", "\x1c", "\t", "e f g h i "]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 90))) for _ in range(400)] + ["", None, "w " * 30_000, CLEAN]
    out = quality.judge(docs(list(enumerate(texts)) + [(None, CLEAN), (0, texts[0])]), PIECES).collect()
    assert len(out) == len(texts) + 2
    for r in out:
        text = (CLEAN if r.doc_id is None else texts[r.doc_id]) or ""
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == _brute(text)
        assert not (r.base_failed and r.kept)


def test_fertility_bands(docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    junk = " ".join(chr(0x10900 + i % 27) * 3 for i in range(60))
    one = quality.judge(docs([(1, CLEAN), (2, junk), (3, "zq " * 9 + "x"), (4, CLEAN)]), PIECES).collect()
    got = {r.doc_id: r for r in one}
    ids = model.encode(CLEAN)
    assert got[1].kept and abs(got[1].chars_per_token - got[1].word_chars / len(ids)) < 1e-9 and got[1].byte_share == 0
    assert got[2].byte_share > 0.9 and not quality.judge(docs([(2, junk)]), PIECES, {"": quality.Band(1, 9, 0.2)}).first().kept
    strict = {"": quality.Band(0.1, 99, 1.0, entropy=9.0, from_tokens=1)}
    assert not quality.judge(docs([(1, CLEAN)]), PIECES, strict).first().kept


def test_only_rejected_rows_go(docs):
    rows = [(1, CLEAN), (1, CLEAN), (None, CLEAN), (2, "too short"), (3, None)]
    out = quality.keep_good(docs(rows), PIECES)
    assert [str(r.doc_id) for r in out.collect()] == ["1", "1", "None"] and out.columns == docs(rows).columns
    assert {r.text for r in out.collect()} == {CLEAN}
    assert quality.keep_good(docs(rows).limit(0), PIECES).count() == 0


def test_bands_reject_junk_and_keep_clean_text(spark):
    random.seed(1)
    letters = lambda low, n: " ".join("".join(chr(low + random.randrange(n)) for _ in range(random.randint(2, 9))) for _ in range(200))
    junk = [letters(97, 26), " ".join(f"{random.getrandbits(32):08x}" for _ in range(200)), letters(0x10900, 27), letters(0x12000, 500)]
    junk += [" ".join(chr(0x20000 + random.randrange(9000)) * 3 for _ in range(80)), " ".join(random.choice("ab") for _ in range(300))]
    clean = {
        "en": [CLEAN],
        "de": ["Der alte Hafen liegt hinter zwei Hügeln, und Schiffe aus vielen Ländern laufen ihn jeden Frühling an, um Salz gegen Wolle zu tauschen."],
        "fr": ["Le vieux port se trouve derrière deux collines, et des navires de nombreux pays y viennent encore chaque printemps échanger du sel."],
        "es": ["El viejo puerto está detrás de dos colinas, y barcos de muchos países llegan todavía cada primavera para cambiar sal por lana."],
        None: [
            CLEAN,
            "Il vecchio porto si trova dietro due colline e navi di molti paesi vi arrivano ancora ogni primavera per scambiare sale con lana.",
            "Stary port leży za dwoma wzgórzami, a statki z wielu krajów wciąż zawijają tam każdej wiosny, aby wymieniać sól na wełnę.",
            "Bến cảng cũ nằm sau hai ngọn đồi, và tàu từ nhiều nước vẫn ghé đến đó mỗi mùa xuân để đổi muối lấy len.",
            "Старая гавань лежит за двумя холмами, и корабли из многих стран всё ещё заходят туда каждую весну, чтобы менять соль на шерсть.",
            "Το παλιό λιμάνι βρίσκεται πίσω από δύο λόφους και πλοία από πολλές χώρες έρχονται ακόμη κάθε άνοιξη για να ανταλλάξουν αλάτι.",
            "오래된 항구는 두 언덕 뒤에 있으며, 많은 나라의 배들이 아직도 매년 봄마다 소금을 양모와 바꾸러 온다.",
            "旧 港口 位于 两座 小山 后面 ， 每年 春天 仍 有 来自 许多 国家 的 船只 来到 那里 用 盐 换 羊毛",
            "يقع الميناء القديم خلف تلين، ولا تزال السفن من بلدان كثيرة تأتي إليه كل ربيع لتبادل الملح بالصوف.",
            "पुराना बंदरगाह दो पहाड़ियों के पीछे है और कई देशों के जहाज अब भी हर वसंत में वहाँ नमक के बदले ऊन लेने आते हैं।",
        ],
    }
    rows = [(0, t, lang) for lang in ("en", "de", "fr", "es", "xx", None) for t in junk]
    rows += [(1, t, lang) for lang, texts in clean.items() for t in texts]
    out = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES).collect()
    assert len(out) == len(rows)
    for r, (want, text, lang) in zip(out, rows):
        assert r.kept == bool(want), (lang, text[:40], r)


def test_numbers_are_judged_apart_from_words(spark):
    """Prose full of prices stays and measures like the same prose without them; tables of numbers, hexadecimal
    words and one sentence over and over with other numbers go."""
    prices = "The shop on the corner sold 3 apples for 2.50, 12 pears for $7.20, 40 eggs for 11.99, 6 loaves for 18.00 and 2 hams for 44.90 on Friday."
    plain = " ".join(w for w in prices.split() if not any(c.isdigit() for c in w))
    table = " ".join(f"{i},{i * i}.{i % 7}" for i in range(100, 300)) + " total"
    same = " ".join(f"Number {i} of {i * i} differs from {i * 7}." for i in range(300))
    mixed = " ".join(f"{random.getrandbits(32):08x}" for _ in range(200))
    rows = [(1, prices, "en"), (2, plain, "en"), (3, table, "en"), (4, same, "en"), (5, mixed, "en"), (6, "1 2 3 4 5 6 7 8 9 10 11 12", None), (7, table, "xx")]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES).collect()}
    assert [got[i].kept for i in range(1, 8)] == [True, True, False, False, False, False, False]
    assert got[1].chars_per_token == got[2].chars_per_token and got[1].n_words == len(prices.split())
    assert got[6].chars_per_token is None and not got[6].base_failed


def test_empty_table(spark):
    assert quality.judge(spark.createDataFrame([], "doc_id long, text string, lang string"), PIECES).count() == 0
