"""Tables that the operators' results depend on."""

# Characters, endings and limits of the cleaning rules.
ANCHORS = "ҕҥөһү"
DIPHTHONGS = ("уо", "иэ", "ыа", "үө")
RUSSIAN_MARKERS = "щцъфв"
RUSSIAN_VERB_ENDINGS = ("ться", "тся", "ешь", "ишь", "л")
RUSSIAN_ADJECTIVE_ENDINGS = ("ий", "ый", "ая", "ое", "ые")
RUSSIAN_NOUN_ENDINGS = ("ость", "ение", "ание")
SAKHA_PLURAL_ENDINGS = ("лар", "лер", "лэр", "лор", "лөр", "тар", "тэр", "тор", "төр", "дар", "дэр", "дор", "дөр", "нар", "нер", "нор", "нөр")
SAKHA_POSSESSIVE_ENDINGS = ("та", "тэ", "тын", "быт")
LOOK_ALIKES = (("6", "ҕ"), ("h", "һ"), ("H", "Һ"), ("o", "ө"), ("O", "Ө"), ("y", "ү"), ("Y", "Ү"), ("8", "ө"))
VOWELS = "аэиоуыеёюяөү"
EXCEPTION_PATTERNS = ("г.", "стр.", "т.д.", "и т.д.")
BLOCK_MARKER = "[[BLOCK]]"
OLD_MARKER = "__WORD_BOUNDARY__"
MAX_WORD_LENGTH = 25
MAX_CONSONANTS = 10
MERGE_LENGTH = 7  # two parts of a broken word have so many letters together, unless one is a single letter

RUSSIAN_ENDINGS = RUSSIAN_VERB_ENDINGS + RUSSIAN_ADJECTIVE_ENDINGS + RUSSIAN_NOUN_ENDINGS
SAKHA_ENDINGS = SAKHA_PLURAL_ENDINGS + SAKHA_POSSESSIVE_ENDINGS
ALL_ENDINGS = RUSSIAN_ENDINGS + SAKHA_ENDINGS
CYRILLIC = "а-яё" + ANCHORS  # lower-case; used with case-insensitive matching
