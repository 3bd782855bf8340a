"""Voters on abusive, hateful and sexual wording: text repair, word classes and patterns over them.

No voter knows a sentence: each combines classes of words (who is meant, what is said of them, what is
done) by nearness.  How far a voter can be trusted is for the label model to find out.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

CATEGORIES = ("abusive", "hateful", "sexual")

# Classes of words, in several languages.

CLASSES: dict[str, str] = {
    "insult": """idiot moron imbecile cretin halfwit dumbass asshole arsehole ass arse bastard bitch scumbag loser clown pig dimwit nitwit fool
        jerk dickhead prick twat wanker cunt motherfucker fucker scum slut whore freak degenerate retard dipshit shithead bonehead numbskull swine
        coward liar crook quack hag creep weasel airhead douchebag tosser bellend git trash garbage filth leech
        idiota imbécil pendejo cabrón gilipollas estúpido basura puta mierda subnormal payaso cerdo zorra
        arschloch arschlöcher vollidiot dummkopf schlampe hurensohn wichser dreck miststück kuh schwein trottel depp blödmann
        connard connards connasse salope ordure abruti enculé crétin merde salaud imbécile cochon
        идиот идиоты дурак дебил тварь твари сволочь ублюдок мразь сука урод скотина козёл""",
    "contempt": """worthless useless pathetic spineless brainless incompetent disgusting filthy lying stupid bloody damn dumb lazy rotten
        ugly miserable vile despicable ridiculous heartless clueless idiotic moronic hopeless mindless gutless shameless fat
        inútil inútiles asqueroso estúpida dumme dummer nutzloses nutzlos verdammten verdammte blöde widerlich incapable incapables pauvre sale nul minable
        никчёмные никчёмный тупой тупая тупые мерзкий жалкий""",
    "curse": """fuck fucking fucked shit shitty bullshit damn crap bollocks puta mierda joder coño hijo scheiße scheisse verfickt merde putain bordel сука блядь хуй чёрт""",
    "you": """you your yours yourself yourselves ya u ur du dich dir dein deine ihr euch euer eure sie tu te toi ton ta tes vous votre vos tú ti tus eres usted
        ustedes os ты тебя тебе твой твоя вы вас вам ваш ваша""",
    "they": "they them their theirs themselves those these ihnen ihre deren diese alle ils eux leur leurs ces ellos ellas esos estos les они их им эти",
    "i": "i me my mine myself ich mich mir mein meinem meiner je moi mon ma yo mi mis quiero хочу я мне меня мой",
    "will": "will ll gonna going shall promise swear better werde komme wirst vais va voy vas буду я",
    "hope": "hope hopes wish should deserve deserves ought please ojalá soll sollst sollen hoffentlich espère пусть чтоб чтобы let lets lasst may would go",
    "harm": """kill hurt smash crack beat burn break punch stab shoot strangle slap destroy ruin slit bash kick harm choke hunt drown cut bury
        fertig umbringen schlagen töten verprügeln tuer frapper casser buter matar golpear romper pegar убить убью бить сломаю зарежу""",
    "body": "face skull teeth neck legs bones head throat jaw knees ribs fingers guts gesicht kopf figure gueule tête cara cabeza dientes лицо морду голову",
    "death": "die dies died dead death rot choke suffer hang hell cancer grave mueras muere muérete verrecke verreckt stirb krepier crève mourir сдохни сдохли сдох умри",
    "place": "live park work sleep drive stay home house car door street family kids children back wohnst habites vives живёшь",
    "nobody": "nobody noone none niemand personne nadie никто",
    "miss": "miss misses missed like likes love loves care cares want wants need needs vermisst aime manque quiere нужен",
    "beast": """animal animals vermin parasite parasites rat rats subhuman subhumans infest infested infesting infestation cockroach cockroaches plague
        swarm scum filth breed breeding monkey monkeys ape apes dogs pigs pest pests lice maggots locusts savages barbarians
        animales plaga ratas parásitos basura bestias ungeziefer parasiten tiere ratten abschaum pack vermine parasites bêtes racaille
        животные животных паразиты крысы твари отбросы""",
    "vice": """thief thieves criminal criminals lazy dirty filthy liars terrorists rapists inferior stupid worthless smelly greedy violent evil crooks scroungers
        sucios ladrones vagos criminales dreckige dreckig faul kriminelle diebe sales voleurs fainéants criminels грязные воры преступники ленивые хуже""",
    "group": """foreigner foreigners immigrant immigrants migrant migrants refugee refugees stranger strangers outsiders muslims jews christians hindus arabs
        africans asians gypsies blacks whites women females gays lesbians homosexuals transgender queers disabled cripples tribe tribes race races
        people folk folks accent religion faith skin
        extranjeros inmigrantes refugiados moros gitanos mujeres ausländer flüchtlinge migranten asylanten juden moslems frauen étrangers immigrés migrants
        réfugiés arabes juifs femmes приезжие приезжих мигранты мигрантов чужаки иностранцы женщины""",
    "all": "all every each typical always everyone any whole alle jeder typisch tous toutes chaque todos todas cada все каждый",
    "are": "are is were be sind ist son es sont est été это",
    "not": "not no never don doesn isn aren shouldn nicht kein keine pas non jamais ne nunca не нет ни nor without",
    "due": """treated served helped touched cared deserve deserves belong belongs allowed welcome medicine care help vote drive treatment
        gehören verdienen medizin behandelt mérite méritent soigner soignés medicina merecen atender лечить достойны""",
    "away": """send deport expel ban banned kick kicked throw thrown keep kept remove back out leave infested dehors jette jeter chasser raus weg abschieben
        larguen fuera echar expulsar вон гнать гоните выгнать""",
    "refuse": "refuse refuses sign rule policy why waste wasting weigere pourquoi porqué зачем",
    "sex": """tits tit boobs cock dick pussy horny blowjob cum orgasm boner nipples clit penis vagina erection porn sex slutty sexy aroused
        geil geiles titten schwanz fotze cachondo cachonda tetas polla coño chatte nichons seins сиськи член""",
    "nude": "naked nude nudes nudity topless undressed bare panties lingerie underwear nackt nacktbilder desnuda desnudo nue голая голый обнажённая",
    "act": """fuck fucking lick licking suck sucking lay screw shag masturbate masturbating ficken lecken blasen follar follarte chupar baiser lécher sucer трахнуть трахать""",
    "touch": "touch touching taste kiss feel rub stroke undress strip rip caress squeeze spank bend lean tongue lips küssen anfassen ausziehen embrasser caresser déshabiller besar tocar quitar раздевайся целовать",
    "lust": "want love dream dreaming picture picturing imagine imagining thinking crave fantasy fantasies wish dying quiero envie rêve мечтаю",
    "photo": "picture pictures photo photos pic pics selfie video bilder fotos foto fotografía фото",
    "give": "send show sent gimme mail schick zeig envoie montre mándame envíame пришли покажи",
    "night": "bed night tonight nacht bett nuit lit noche cama ночь постель shower couch backseat room",
    "clothes": "clothes shirt skirt dress trousers pants panties bra uniform stockings kleider vêtements ropa одежду",
    "pet": "babe baby sexy sweetie sugar honey gorgeous darling hottie sweetheart cutie doll cariño guapa chérie schätzchen süße детка",
    "report": """denies denied screen screening reported reports report discrimination harassment complaint complained complains complaints policy training abuse quoted
        logged incident incidents witness allegedly called leaflet log error exit process host server query""",
    "self": "sorry embarrassed ashamed ashame silly felt feel feeling worried",
    "clinic": """exam examination health history swab catheter dressing wound soreness nursing leaflet diaper discharge lesion rash tender lump screening
        mammogram cervical prostate contraception education stoma biopsy ulcer""",
}

#: Sequences in scripts without blanks, by class.
SEQUENCES: dict[str, str] = {
    "insult": "傻逼 混蛋 蠢货 白痴 废物 馬鹿 バカ クズ ばか野郎 غبي أحمق حقير बेवकूफ कमीना हरामी",
    "death": "死ね 去死 مت", "beast": "害虫 畜生 حشرات कीड़े", "group": "外国人 移民 أجانب विदेशी", "nude": "裸 عارية नंगी", "sex": "おっぱい 胸部 エッチ", "you": "你 您 あなた お前 أنت तुम आप",
}

#: Phrases, where the order of words matters.
PHRASES: dict[str, str] = {
    "dismiss": r"shut (?:up|your)|(?:go|rot) (?:to|in) hell|(?:go|just) (?:rot|die|hang)|fuck (?:you|off)(?! on)|(?:piss|bugger|sod) off|get lost|screw you|crawl (?:back|away|into)|drop(?:ped)? dead|up yours"
    r"|halt(?:s|et)? (?:die|deine|das|s)? ?(?:fresse|maul|klappe)|cállate|vete al?|ferme[zr]? (?:ta|vos|la) gueule|ta gueule|va te faire|закрой (?:рот|пасть)|заткнись|пошёл|пошел|滚|黙れ",
    "below": r"(?:smarter|better|more use|more sense|more brains?) than (?:you|all of you)|(?:not|n't) fit to|a brain(?:cell)?|shame on you|sick of you|(?:should|must) (?:never|not) (?:have )?(?:be|been|become|work|touch|get)",
    "inhuman": r"(?:not|n't|hardly|barely|less than|never|no) (?:even |really |fully |quite )?human|sub-?human|keine menschen|pas (?:même )?humains?|no son humanos|не люди|нелюди",
    "nature": r"by nature|by birth|in (?:their|the) (?:blood|genes|nature|dna)|born (?:that way|thieves|to)|(?:every|each) (?:last |single )?one of|all the same|always (?:will be|have been)|von natur|par nature|por naturaleza|по природе|в крови",
    "back": r"(?:send|sent|ship|throw|kick|drive|chase|keep|kept|get|put|push)\w* (?:\w+ ){0,4}(?:back|out|away|off|home)|back (?:to )?where|where (?:they|you) (?:came|come|crawled|belong)|go (?:back|home)|raus mit|weg mit|que se (?:larguen|vayan)|qu on (?:les|me les)|гоните|вон из",
    "fade": r"let (?:them|those|these|it all) (?:all )?(?:die|rot|burn|starve|suffer|drown)|die out|wipe\w* (?:them )?out|get rid of (?:them|those|these)|gas (?:them|all)",
    "warned": r"watch (?:your|ur) (?:back|step|mouth|tongue)|better (?:run|hide|pray)|over your shoulder|(?:know|find out|found out) where (?:you|u)|you (?:have been|re|are) (?:warned|dead|finished)|or else",
    "lurk": r"where (?:you|ur|u) \w+|behind your|wait\w* for you|(?:find|follow\w*|come for|after) you|(?:pay|regret|sorry) for (?:it|this|that)|you (?:will|ll) (?:pay|regret|see)|get(?:s|ting)? hurt",
    "advance": r"(?:on|in|over) my (?:lap|bed|face|place)|come over|(?:lean|bend|kneel)\w* (?:over|down)|hot (?:sex|night)|have sex|make love|(?:take|rip|tear)\w* (?:off )?your|without (?:panties|clothes|underwear|a bra)|touching (?:my|your)self|(?:make|makes|making) me (?:so )?\w+",
    "selfish": r"(?:i feel|i am|i m|i was|i look|me feel|makes me look|felt) (?:a bit |so |such an? |really |like an? )?(?:\w+ )?(?:stupid|idiot|useless|dumb|worthless|fool|silly|pathetic|ugly|fat)|stupid (?:question|mistake|of me)",
    "quoted": r"(?:called|calls|calling) (?:me|him|her|us|them|it|staff|someone)|(?:was|were|been|being) (?:told|called|shouted)|abuse (?:towards|of|against)|sexual (?:health|history|abuse|assault|function)",
}

#: Words without one of which a phrase is not said.
TRIGGERS: dict[str, frozenset[str]] = {k: frozenset(v.split()) for k, v in {
    "dismiss": "shut hell rot die hang fuck piss bugger sod lost screw crawl drop dropped up halt halts haltet cállate vete ferme fermez fermer ta va закрой заткнись пошёл пошел 滚 黙れ",
    "below": "than fit brain braincell shame sick never not", "inhuman": "human humans subhuman subhumans menschen humain humains humanos люди нелюди", "nature": "nature birth blood genes dna born every each same always natur naturaleza природе крови",
    "back": "back out away off home where raus weg larguen vayan les гоните вон", "fade": "let die wipe wiped wiping rid gas", "warned": "watch better shoulder where warned dead finished else",
    "lurk": "where behind wait waiting waits find follow following follows come after pay regret sorry see hurt", "advance": "my over down sex night off your without touching make makes making love",
    "selfish": "feel am m was look me felt stupid", "quoted": "called calls calling told shouted abuse sexual",
}.items()}

HIDDEN = re.compile("[­​-‏‪-‮⁠-⁤﻿]")
LINE, BLACK = re.compile(r"[\r\n]+"), re.compile(r"\S+")
STOP = re.compile(r"[.!?\s。！？।؟](?:(?<=[^!][.!?])\s+|(?<=[。！？।؟])\s*|(?<=\s)\s+(?=[A-Z]))")
SPEAKER = re.compile(r"^\s*(?:[-•*]\s*)?(?:\w{2,8}:\s+)?")
SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .\-_]{1,2}){2,}[^\W\d_]{1,2}(?![^\W_])")
TOKEN = re.compile(r"[^\s,;:?\"“”()\[\]<>]+")
WORD = re.compile(r"[^\W\d_]+")
LATIN, CYRILLIC = re.compile("[a-z]"), re.compile("[Ѐ-ӿ]")
RUN = re.compile(r"(.)\1+")
LONG_RUN = re.compile(r"(\w)\1\1")
ODD = re.compile(r"[*$@]|[a-z]\d|\d[a-z]|(\w)\1\1|[Ѐ-ӿ]", re.I)
#: Quick looks: whether letters may be set apart, and whether there are signs that disguises are made of.
SET_APART, SIGNS = re.compile(r"[^\W\d_][ .\-_]{1,2}[^\W\d_][ .\-_]{1,2}[^\W\d_]"), re.compile(r"[*$@\dЀ-ӿ]")
#: Letters that look alike, by the Latin letter they stand for, and signs that stand for letters.
LOOKALIKES = str.maketrans("аеорсухіѕјԁһӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧοαν", "aeopcyxisjdhlABEZHIKMNOPTYXoav")
LEET = str.maketrans("013457$@!9", "oieastsaig")

#: Plural words that name where people come from, by their endings, and callings that end alike.
DEMONYM = re.compile(r"\w{3,}(?:[^c]ians|eans|anders|rans|vans|ese|stanis|iens|iers|aner|ianos|eños|чане|ийцы)\Z")
_CALLINGS = frozenset("guardians civilians veterans vegetarians librarians pedestrians oceans jeans beans means cleans leans bystanders commanders germans custodians comedians".split())

#: Longest segment in words; longer ones are read in windows that overlap by half.
WINDOW = 24


def _plurals(word: str) -> list[str]:
    return [word] if not word.isascii() or word.endswith("s") else [word, word + "s", *([word + "es"] if word.endswith(("sh", "ch", "x")) else [])]


NAMES = list(CLASSES)
BIT = {n: 1 << i for i, n in enumerate(NAMES)}
WORDS: dict[str, int] = {}
for _c, _list in CLASSES.items():
    for _w in _list.split():
        for _v in _plurals(_w) if _c == "insult" else [_w]:
            WORDS[_v] = WORDS.get(_v, 0) | BIT[_c]
_SEQUENCE = {s: BIT[c] for c, own in SEQUENCES.items() for s in own.split()}
_SEQUENCES = re.compile("|".join(sorted(_SEQUENCE, key=len, reverse=True)))
_BLANKLESS = re.compile("[؀-ۿऀ-ॿ぀-ヿ一-鿿]")
_PHRASE = {n: re.compile(rf"(?<!\w)(?:{p})(?!\w)") for n, p in PHRASES.items()}

#: Words that disguises are undone for.
LEXICON = frozenset(w for w, bits in WORDS.items() if len(w) > 2 and bits & sum(BIT[c] for c in ("insult", "contempt", "curse", "beast", "vice", "sex", "nude", "act"))) | frozenset("people hell nurse".split())


def _squeeze(word: str) -> str:
    return RUN.sub(r"\1", word)


_SQUEEZED: dict[str, str] = {}
_BY_LENGTH: dict[int, list[str]] = {}
for _w in sorted(LEXICON):
    _SQUEEZED.setdefault(_squeeze(_w), _w)
    _BY_LENGTH.setdefault(len(_w), []).append(_w)


def _known(word: str) -> str | None:
    if word in LEXICON:
        return word
    return _SQUEEZED.get(_squeeze(word)) if LONG_RUN.search(word) else None


def _plain(token: str) -> str:
    """A token with its disguise taken off, where that gives a word of the lists; else as it was."""
    core = token.rstrip(".!'")
    if LATIN.search(core) and CYRILLIC.search(core):
        core = core.translate(LOOKALIKES)
        token = core
    if (w := _known(core)) is not None:
        return w
    if any(c in "013457$@!9" for c in core) and re.search("[^\\W\\d_]|[$@]", core):
        for c in (core.translate(LEET), core.replace("1", "l").translate(LEET)):
            if (w := _known(c)) is not None or (w := _SQUEEZED.get(_squeeze(c)) if "$" in core else None) is not None:
                return w
    if "*" in core and len(core) > 2 and core.strip("*"):
        shape = re.compile("".join(r"\w" if c == "*" else re.escape(c) for c in core) + r"\Z")
        for w in _BY_LENGTH.get(len(core), ()):
            if shape.match(w):
                return w
    return token


def _joined(match: re.Match[str]) -> str:
    """Letters set apart, put together; two words run into one are parted again."""
    s = re.sub(r"[ .\-_]", "", match.group(0))
    if (w := _known(s)) is not None:
        return w
    for i in range(2, len(s) - 1):
        a, b = _known(s[:i]), _known(s[i:])
        if a and b:
            return f"{a} {b}"
    return match.group(0)


def repair(segment: str) -> str:
    """Lower case, without hidden characters, look-alike letters, digits for letters, stretched, masked or spaced words."""
    s = segment if segment.isascii() else unicodedata.normalize("NFKC", HIDDEN.sub("", segment))
    s = s.lower()
    if SET_APART.search(s):
        s = SPACED.sub(_joined, s)
    if (ODD if SIGNS.search(s) else LONG_RUN).search(s):
        s = TOKEN.sub(lambda m: _plain(m.group(0)), s)
    return s


def _sentences(line: str) -> list[str]:
    out, at = [], 0
    for m in STOP.finditer(line):
        i = m.start()
        out.append(line[at:i if line[i].isspace() else i + 1])
        at = m.end()
    out.append(line[at:])
    return out


def segments(text: str) -> list[str]:
    """Sentences, lines and turns of a text, without speaker labels; long ones as windows of ``WINDOW`` words that overlap by half."""
    out = []
    for line in LINE.split(text):
        for s in _sentences(line):
            t = s.strip()
            if ":" in t or t[:1] in "-•*":
                t = SPEAKER.sub("", t).strip()
            if len(t) <= 4 * WINDOW:
                if t:
                    out.append(t)
                continue
            ends = [m.span() for m in BLACK.finditer(t)]
            if len(ends) <= WINDOW * 3 // 2:
                out.append(t)
            else:
                out += [t[ends[i][0]:ends[min(i + WINDOW, len(ends)) - 1][1]] for i in range(0, len(ends) - WINDOW // 2, WINDOW // 2)]
    return out


def words(repaired: str) -> list[str]:
    """Words of a repaired segment; texts in scripts without blanks give pairs of letters besides."""
    w = WORD.findall(repaired)
    if _BLANKLESS.search(repaired):
        w += [x[i:i + 2] for x in w if _BLANKLESS.match(x) for i in range(len(x) - 1)]
    return w


@lru_cache(maxsize=200_000)
def _bits(word: str) -> int:
    b = WORDS.get(word, 0)
    if not b and DEMONYM.match(word) and word not in _CALLINGS:
        b = BIT["group"]
    if _BLANKLESS.search(word):
        for m in _SEQUENCES.finditer(word):
            b |= _SEQUENCE[m.group()]
    return b


@lru_cache(maxsize=200_000)
def classes(word: str) -> tuple[str, ...]:
    b = _bits(word)
    return tuple(n for n in NAMES if b & BIT[n]) if b else ()


class Seen:
    """A segment's words by class."""

    def __init__(self, tokens: list[str]):
        self.tokens, self.said, self.text = tokens, set(tokens), ""
        self.known: dict[str, bool] = {}
        self.at: dict[str, list[int]] = {}
        self.any = 0
        for i, w in enumerate(tokens):
            b = _bits(w)
            self.any |= b
            while b:
                low = b & -b
                self.at.setdefault(NAMES[low.bit_length() - 1], []).append(i)
                b ^= low
        if "group" in self.at and "you" in self.at:  # you people: those spoken to, not a group spoken about
            self.at["group"] = [i for i in self.at["group"] if i - 1 not in self.at["you"]]
            if not self.at["group"]:
                del self.at["group"]

    def has(self, *classes: str) -> bool:
        return all(c in self.at for c in classes)

    def near(self, a: str, b: str, most: int) -> bool:
        """Whether a word of each class stand at most ``most`` words apart; one word of both classes does not count."""
        x, y = self.at.get(a), self.at.get(b)
        return bool(x and y) and any(0 < abs(i - j) <= most for i in x for j in y)

    def follows(self, a: str, b: str, most: int) -> bool:
        x, y = self.at.get(a), self.at.get(b)
        return bool(x and y) and any(0 < j - i <= most for i in x for j in y)

    def kinds(self, *classes: str) -> int:
        """Of how many words of any of the classes the segment has."""
        return len({i for c in classes for i in self.at.get(c, ())})

    @property
    def aimed(self) -> bool:
        """Whether what is said is said of the one spoken to."""
        return any(self.near("you", c, 4) for c in ("insult", "contempt", "beast", "vice"))

    def says(self, phrase: str) -> bool:
        got = self.known.get(phrase)
        if got is None:
            got = not TRIGGERS[phrase].isdisjoint(self.said)
            if got:
                self.text = self.text or " ".join(self.tokens)
                got = _PHRASE[phrase].search(self.text) is not None
            self.known[phrase] = got
        return got


#: What a voter's vote is worth before any data is seen: right nearly always, half the time, seldom, or a vote against.
STRONG, EVEN, WEAK, AGAINST = 0.9, 0.5, 0.05, 0.0
#: Name, worth, when it fires, and voters whose votes already say as much, so that it is silent beside them.
Voter = tuple

_ABOUT_YOU: list[Voter] = [
    ("insult_at_you", STRONG, lambda s: s.near("you", "insult", 6)),
    ("contempt_and_insult", STRONG, lambda s: s.follows("contempt", "insult", 3) or s.near("curse", "insult", 2)),
    ("contempt_at_you", EVEN, lambda s: s.near("you", "contempt", 2) or s.follows("you", "contempt", 4) and s.near("you", "are", 2)),
    ("contempt_twice", EVEN, lambda s: s.kinds("contempt", "insult") >= 2 and s.has("you"), "contempt_and_insult insult_at_you"),
    ("curse_at_you", EVEN, lambda s: s.near("curse", "you", 3) and not s.near("lust", "act", 9)),
    ("harm_announced", STRONG, lambda s: s.follows("will", "harm", 9) and s.has("you")),
    ("harm_to_your_body", STRONG, lambda s: s.near("harm", "body", 4) and s.has("you")),
    ("warned", STRONG, lambda s: s.says("warned")),
    ("lurking", EVEN, lambda s: s.says("lurk"), "warned"),
    ("lurking_at_your_place", EVEN, lambda s: s.says("lurk") and s.near("you", "place", 2), "warned"),
    ("death_wished", STRONG, lambda s: s.near("hope", "death", 6) and s.has("you")),
    ("death_of_you", EVEN, lambda s: s.near("you", "death", 3), "death_wished"),
    ("not_missed", EVEN, lambda s: s.follows("nobody", "miss", 3) and s.has("you")),
    ("sent_off", EVEN, lambda s: s.says("dismiss")),
    ("belittled_beast", EVEN, lambda s: s.says("below") and (s.has("beast") or s.has("insult"))),
    ("belittled", WEAK, lambda s: s.says("below") and s.has("you"), "belittled_beast"),
    ("insult_elsewhere", WEAK, lambda s: s.has("insult"), "insult_at_you contempt_and_insult"),
    ("curse_elsewhere", WEAK, lambda s: s.has("curse") and not s.near("lust", "act", 9), "curse_at_you contempt_and_insult insult_elsewhere"),
    ("against_group", AGAINST, lambda s: not s.has("you") and (s.has("group") or s.has("all", "vice"))),
    ("against_self", AGAINST, lambda s: s.says("selfish")),
    ("against_report", AGAINST, lambda s: s.says("quoted") or s.has("report")),
]
_ABOUT_GROUPS: list[Voter] = [
    ("group_and_beast", STRONG, lambda s: s.near("group", "beast", 7)),
    ("are_beasts", EVEN, lambda s: s.follows("are", "beast", 4) and not s.near("you", "are", 1)),
    ("they_and_beast", EVEN, lambda s: s.near("they", "beast", 6)),
    ("not_human", STRONG, lambda s: s.says("inhuman")),
    ("beasts_twice", EVEN, lambda s: s.kinds("beast", "vice") >= 2 and not s.aimed, "group_and_beast"),
    ("group_and_vice", EVEN, lambda s: s.near("group", "vice", 6)),
    ("group_sent_off", EVEN, lambda s: (s.has("group") or s.has("they") or s.has("all")) and s.says("back")),
    ("group_shut_out", EVEN, lambda s: s.near("group", "away", 6)),
    ("group_denied", EVEN, lambda s: s.near("not", "due", 6) and s.has("group")),
    ("group_refused", EVEN, lambda s: s.has("refuse") and (s.has("group") or s.has("they")) and (s.has("due") or s.has("not"))),
    ("left_to_die", STRONG, lambda s: s.says("fade")),
    ("by_nature", EVEN, lambda s: s.says("nature")),
    ("all_of_group", WEAK, lambda s: s.near("all", "group", 3)),
    ("group_alone", WEAK, lambda s: s.has("group"), "group_and_beast group_and_vice group_sent_off group_shut_out group_denied group_refused all_of_group"),
    ("beast_alone", WEAK, lambda s: s.has("beast") and not s.aimed, "group_and_beast are_beasts they_and_beast beasts_twice"),
    ("against_you", AGAINST, lambda s: s.aimed),
    ("against_report", AGAINST, lambda s: s.says("quoted") or s.has("report")),
]
_SEXUAL: list[Voter] = [
    ("sex_and_you", STRONG, lambda s: s.near("sex", "you", 6) or s.near("act", "you", 4) and not s.says("dismiss")),
    ("sex_and_me", EVEN, lambda s: s.near("sex", "i", 6), "sex_and_you"),
    ("sex_twice", STRONG, lambda s: s.kinds("sex", "nude", "act") >= 2),
    ("nude_and_you", STRONG, lambda s: s.near("nude", "you", 4)),
    ("nude_pictures", STRONG, lambda s: s.near("nude", "photo", 4)),
    ("lust_and_touch", EVEN, lambda s: s.near("lust", "touch", 6) and s.has("you")),
    ("lust_and_sex", EVEN, lambda s: s.near("lust", "sex", 8) or s.near("lust", "act", 8) or s.near("lust", "nude", 6)),
    ("undressing", EVEN, lambda s: s.near("touch", "clothes", 4) and s.has("you")),
    ("pictures_sent", WEAK, lambda s: s.near("give", "photo", 5) and (s.has("nude") or s.has("pet"))),
    ("advance", EVEN, lambda s: s.says("advance")),
    ("touch_and_pet_name", EVEN, lambda s: s.has("pet") and (s.has("touch") or s.has("lust"))),
    ("night", WEAK, lambda s: s.has("night") and (s.has("sex") or s.has("nude") or s.has("act") or s.has("lust"))),
    ("sex_word", EVEN, lambda s: s.has("sex"), "sex_and_you sex_and_me sex_twice lust_and_sex"),
    ("act_word", WEAK, lambda s: s.has("act") and not s.says("dismiss"), "sex_and_you sex_twice lust_and_sex"),
    ("nude_word", WEAK, lambda s: s.has("nude"), "nude_and_you nude_pictures sex_twice lust_and_sex"),
    ("pet_name", WEAK, lambda s: s.has("pet"), "touch_and_pet_name"),
    ("against_curse", AGAINST, lambda s: s.says("dismiss") or s.has("insult")),
    ("against_clinic", AGAINST, lambda s: s.has("clinic") or s.says("quoted")),
    ("against_report", AGAINST, lambda s: s.has("report")),
]
DEFINED: dict[str, list[Voter]] = {"abusive": _ABOUT_YOU, "hateful": _ABOUT_GROUPS, "sexual": _SEXUAL}
VOTERS = {c: [n for n, *_ in v] for c, v in DEFINED.items()}
WORTH = {c: [w for _, w, *_ in v] for c, v in DEFINED.items()}
_RULES = {c: [(v[2], sum(1 << VOTERS[c].index(n) for n in " ".join(v[3:]).split())) for v in own] for c, own in DEFINED.items()}
#: Classes without a word of which no voter can fire but those of phrases alone.
_TELLING = sum({BIT[c] for c in "insult contempt curse harm death nobody beast vice group they sex nude act touch pet lust report clinic you away refuse".split()})


def votes(tokens: list[str]) -> tuple[int, int, int]:
    """Of each category, the bits of the voters that fire on a repaired segment's words."""
    s = Seen(tokens)
    if not s.any & _TELLING:
        return 0, 0, 0
    out = []
    for c in CATEGORIES:
        mask = 0
        for i, (fires, said) in enumerate(_RULES[c]):
            if not mask & said and fires(s):
                mask |= 1 << i
        out.append(mask)
    return tuple(out)


@lru_cache(maxsize=100_000)
def judged(segment: str) -> tuple[tuple[str, ...], tuple[int, int, int]]:
    """Words of the repaired segment and its votes; segments that recur are worked out once per worker."""
    w = words(repair(segment))
    return tuple(w), votes(w)
