"""Word lists of the rules.

Fixed values: the rules are defined by these lists. Product, vendor and domain-corpus words that a
user owns are parameters of Lexicon instead.
"""

from __future__ import annotations

from dataclasses import dataclass, field

W = str.split

SHORT_COMMON = W("add new old get set put run use end top big low high read last next prev back main view")
ACTIONS = W("add create delete edit move copy paste cut open close save load update insert remove clear reset undo redo select click")
ADJECTIVES = W("new old big small easy hard fast slow high low simple basic advanced general common normal standard default custom quick different")
UI_NOUNS = W("button click menu dialog window screen panel tab icon label field form page view list table row column")
COLORS = W("red blue green yellow black white gray grey orange purple pink brown")
DIRECTIONS = W("up down left right top bottom front back next previous first last")

GENERIC_ACTIONS = W(
    "add remove create delete edit modify change update insert append push pull get set put fetch open close start stop begin end finish complete "
    "save load export import upload download click select choose pick activate enable disable show hide display view preview refresh reload"
)
GENERIC_STATES = W(
    "new old current previous next first last active inactive enabled disabled available unavailable valid invalid empty full complete incomplete "
    "simple complex easy hard basic advanced general specific common uncommon normal abnormal standard custom default optional required "
    "quick slow fast rapid instant immediate different same similar identical unique"
)
GENERIC_UI = W(
    "button link menu dialog window screen page panel tab pane section area region zone field box form input output label caption "
    "icon image picture photo graphic chart graph list table grid tree row column cell item"
)
GENERIC_SIZES = W("small large big tiny huge wide narrow high low tall short long brief top bottom left right center middle up down front back side corner edge")
GENERIC_TIMES = W("time date day week month year hour minute second today yesterday tomorrow now later soon")
GENERIC_NOUNS = W(
    "thing item object element component part piece data info information detail content text value number count total amount quantity size length "
    "name title description note comment message type kind category class group set collection status state mode option setting preference "
    "file folder directory path location place position user admin owner member person account profile system application program tool utility feature "
    "error warning alert notification message language format version level priority order"
)
PAIR_ACTIONS = W("add create delete edit remove new old save load open close view show hide select click")
PAIR_UI = W("menu button view screen dialog panel tab page")

TECHNICAL_SUFFIXES = W("tion sion ization isation ment ness ity ence ance able ible ive al ic ous ful less er or ist")
DOMAIN_ROOTS = W(
    "extrude revolve loft sweep fillet chamfer shell draft serialize deserialize batch inventory warehouse production material component assembly operation cnc "
    "gcode toolpath metric dimension tolerance constraint parameter variable offset pattern array mirror scale rotate translate api endpoint webhook "
    "authentication authorization token json xml http rest graphql sdk integration"
)

#: Context types in the order in which they are tried.
CONTEXT_TYPES = (
    ("UI", W("click button screen interface ui menu")),
    ("API", W("api endpoint json http request response")),
    ("Inventory", W("product inventory warehouse material stock")),
    ("Production", W("production operation worker machine shift")),
    ("CAD", W("cad 3d model extrude revolve assembly")),
    ("Analytics", W("report dashboard analytics chart graph")),
)

VERY_COMMON = W(
    "the be to of and a in that have i it for not on with he as you do at this but his by from they we say her she or an will my one all would there "
    "their what so up out if about who get which go me when make can like time no just him know take people into year your good some could them see other "
    "than then now look only come its over think also back after use two how our work first well way even new want because any these give day most us"
)
UI_COMMON = W(
    "add edit delete remove create update save load open close start stop show hide view display select click set get check button menu file item list "
    "table form field option setting data"
)
ULTRA_GENERIC = W(
    "the and for are but not you all can will just with from have this that what when where which who how more some other new good first last long great "
    "little own same old"
)
UI_VERBS = W(
    "add edit delete remove create update save load open close start stop enable disable show hide view display select filter sort search find replace "
    "copy paste cut undo redo refresh click press toggle switch check uncheck"
)
SINGLE_UI_NOUNS = W("button menu window dialog panel tab page form field label icon toolbar option setting mode state status type item list table grid tree chart")
BROAD = W(
    "thing stuff part piece bit section area way method process system tool feature action operation task job activity step type kind sort category class "
    "group element component object entity unit value number amount quantity size level condition situation case instance example"
)
SINGLE_DOMAIN = W(
    "extrude revolve loft sweep fillet chamfer constraint dimension sketch spline mesh wireframe tessellation parametric machining toolpath fixture jig "
    "routing workstation throughput downtime scrap rework kanban kaizen lean takt tolerance clearance interference datum gd&t simulation fea cae "
    "optimization cad cam bim plm erp mes cnc api"
)
ACRONYMS = W("cad cam plm erp mes cnc bim fea cae pdm api sdk xml json sql http 3d 2d stl obj fbx dwg dxf")
AFFIX_SUFFIXES = ("ing", "tion", "ment", "ness", "ity", "ance", "ence")
AFFIX_PREFIXES = ("pre", "post", "sub", "super", "inter", "multi")
PAIR_BROAD = W(
    "thing stuff part piece bit section area place way method process system tool feature function action operation task job work activity step type kind "
    "sort category class group set item element component object entity unit value number amount quantity size level state status mode condition situation "
    "new old current previous next last first all any some each every other another"
)
PAIR_DOMAIN = W(
    "cad bim model drawing sketch assembly part dimension constraint extrude revolve loft sweep fillet chamfer pattern mirror offset trim mesh surface "
    "solid wireframe spline curve manufacturing production inventory warehouse batch operation workstation routing bom material component quality "
    "inspection tolerance cnc machining toolpath fixture jig engineering design analysis simulation calculation specification parameter variable equation "
    "formula product project order customer supplier vendor schedule timeline milestone deliverable requirement"
)
PAIR_ADJECTIVES = W("advanced automated custom dynamic integrated")
PAIR_VERBS = W("extrude revolve machine assemble fabricate")
PAIR_GENERIC_VERBS = W("add edit delete remove create update save load open close show hide click")
PAIR_GENERIC_NOUNS = W("button menu dialog window tab panel icon label field option setting")
ULTRA_PHRASES = ("add new", "create new", "new item", "new file", "click here", "click save", "press enter", "set value", "get value", "show all", "hide all")

STOP_LOAD = W("the and for are but not you all can")
TECH_TOKENS = W("api sdk xml json sql http")

DOMAINS = {
    "cad": W("drawing sketch model dimension layer block polyline"),
    "bim": W("building architecture construction structural mep facility"),
    "manufacturing": W("machining toolpath cnc assembly part component"),
    "animation": W("keyframe timeline rigging rendering shader texture"),
    "simulation": W("analysis mesh solver boundary constraint optimization"),
}
USAGE = {
    "error": W("error failed exception invalid corrupt"),
    "feature": W("tool command function option setting"),
    "workflow": W("process workflow procedure method technique"),
}
RICHNESS = W("parameter property attribute value setting")

SPECIAL_CHARS = r"-_./\@#$%^&*()+=[]{}|;:,<>?"
FILE_WORDS = (".exe", ".dll", ".log", ".txt", ".cfg")
FILE_EXTENSIONS = (".exe", ".dll", ".log", ".txt", ".cfg", ".xml", ".json", ".dwg", ".dxf", ".dmg", ".3mf", ".ifc", ".step", ".iges", ".obj", ".fbx", ".max", ".blend")
ERROR_CHARACTER = W("error fail exception warning")
CODE_PREFIXES = W("err inv aut con")
ERROR_TERMS = W("err error fail exception debug log trace stack")
STOPWORDS = W("and or the a an is are was were be been have has had")
ID_PREFIXES = ("id_", "uid_", "guid_", "uuid_")
WEB_PATTERNS = ("http", "www.", ".com", ".org", ".net", "api_", "url_")
VERSION_PATTERNS = ("v1.", "v2.", "version", "_v", ".0", ".1", ".2")
TECH_DOMAINS = W("max dwg dxf ifc step iges obj fbx api sdk gui ui ux cad cam cae mesh nurbs spline bezier polygon render shader material texture lighting")

CATEGORY_TECH = W("api sdk cpu gpu ram ssd usb wifi http json xml")
CATEGORY_VERSION = ("v1", "v2", "v3", "2.0", "3.0", "pro", "max")
CATEGORY_TECHNICAL = W("software hardware system database network server")
CATEGORY_BUSINESS = W("business market sales revenue customer")
CATEGORY_COMMON = W("family house food hospital school car")

CONTEXT_PATTERNS = (
    ("command", W("command cmd function tool option")),
    ("feature", W("feature capability function tool")),
    ("process", W("process workflow procedure method")),
    ("object", W("object element component item")),
    ("interface", W("dialog window panel menu button")),
    ("file", W("file document export import save")),
    ("modeling", W("3d model mesh surface geometry")),
    ("cad", W("drawing design draft sketch")),
    ("graphics", W("render material texture lighting visual")),
)
CONTEXT_ACTIONS = W("create modify edit delete move copy select draw design")

REVIEW_KEYWORDS = W("design model drawing sketch dimension layer feature assembly component manufacturing engineering cad cam")
INDUSTRY_KEYWORDS = W("design drawing model sketch dimension layer process production assembly machine tool quality building construction architecture structure civil engineering")
WEB_FAILURES = ("failed", "error", "timeout", "no results", "timed out", "connection")

LANGUAGE_CODES = {
    "CSY": W("cs csy czech"), "ENG": W("en eng english"), "FRE": W("fr fre french"), "DEU": W("de deu german"), "ESP": W("es esp spanish"), "ITA": W("it ita italian"),
    "POR": W("pt por portuguese"), "RUS": W("ru rus russian"), "JPN": W("ja jpn japanese"), "CHS": W("zh chs chinese"), "CHT": W("zh-tw cht chinese-traditional"),
    "KOR": W("ko kor korean"), "NLD": W("nl nld dutch"), "PLY": W("pl ply polish"), "DAN": W("da dan danish"), "TUR": W("tr tur turkish"),
}
STANDARD_CODES = {"ENG": "EN", "CSY": "CS", "FRE": "FR", "DEU": "DE", "ESP": "ES", "ITA": "IT", "POR": "PT", "RUS": "RU", "JPN": "JA", "CHS": "ZH", "CHT": "ZH-TW", "KOR": "KO"}
TRANSLATOR_CODES = {
    "de": "deu_Latn", "es": "spa_Latn", "fr": "fra_Latn", "it": "ita_Latn", "ja": "jpn_Jpan", "ko": "kor_Hang", "zh": "zho_Hans", "zh-tw": "zho_Hant",
    "pt": "por_Latn", "ru": "rus_Cyrl", "ar": "arb_Arab", "hi": "hin_Deva", "tr": "tur_Latn", "pl": "pol_Latn", "nl": "nld_Latn", "sv": "swe_Latn",
    "da": "dan_Latn", "no": "nor_Latn", "fi": "fin_Latn", "cs": "ces_Latn", "hu": "hun_Latn", "ro": "ron_Latn", "bg": "bul_Cyrl", "hr": "hrv_Latn",
    "sk": "slk_Latn", "sl": "slv_Latn", "et": "est_Latn", "lv": "lav_Latn", "lt": "lit_Latn", "uk": "ukr_Cyrl", "be": "bel_Cyrl", "mk": "mkd_Cyrl",
    "sq": "sqi_Latn", "sr": "srp_Cyrl", "bs": "bos_Latn", "mt": "mlt_Latn", "is": "isl_Latn", "ga": "gle_Latn", "cy": "cym_Latn", "eu": "eus_Latn",
    "ca": "cat_Latn", "gl": "glg_Latn", "he": "heb_Hebr", "th": "tha_Thai", "vi": "vie_Latn", "id": "ind_Latn", "ms": "zsm_Latn", "tl": "tgl_Latn",
    "bn": "ben_Beng", "ta": "tam_Taml", "te": "tel_Telu", "ml": "mal_Mlym", "kn": "kan_Knda", "gu": "guj_Gujr", "pa": "pan_Guru", "ur": "urd_Arab",
    "fa": "pes_Arab", "sw": "swh_Latn", "am": "amh_Ethi", "yo": "yor_Latn", "ig": "ibo_Latn", "ha": "hau_Latn", "zu": "zul_Latn", "xh": "xho_Latn",
    "af": "afr_Latn", "en": "eng_Latn",
}
MINIMAL_LANGUAGES = W(
    "eng_Latn spa_Latn fra_Latn deu_Latn rus_Cyrl zho_Hans jpn_Jpan kor_Hang arb_Arab hin_Deva mag_Deva prs_Arab bho_Deva eus_Latn ory_Orya ell_Grek heb_Hebr "
    "tha_Thai vie_Latn swh_Latn"
)
CORE_LANGUAGES = MINIMAL_LANGUAGES + W(
    "por_Latn ita_Latn nld_Latn pol_Latn tur_Latn ind_Latn zsm_Latn zho_Hant ben_Beng tel_Telu knc_Arab pbt_Arab hne_Deva kas_Arab mri_Latn mai_Deva guj_Gujr "
    "tam_Taml mar_Deva npi_Deva"
)
EXTENDED_LANGUAGES = CORE_LANGUAGES + W(
    "cat_Latn ron_Latn glg_Latn dan_Latn swe_Latn nob_Latn isl_Latn ces_Latn slk_Latn hrv_Latn bul_Cyrl ukr_Cyrl ary_Arab arz_Arab acm_Arab asm_Beng kan_Knda "
    "mal_Mlym pan_Guru khm_Khmr lao_Laoo mya_Mymr sin_Sinh hau_Latn yor_Latn ibo_Latn som_Latn amh_Ethi kat_Geor hye_Armn bod_Tibt khk_Cyrl pes_Arab urd_Arab "
    "fas_Arab pus_Arab snd_Arab uig_Arab fin_Latn hun_Latn est_Latn lav_Latn lit_Latn"
)
GLOSSARY_DOMAINS = W("ACAD AEC CORE DNM MNE")
DEFAULT_GLOSSARY = {
    "Lisp++": "Lisp++", "vertex": "vrchol", "orient": "orientovat", "file": "soubor", "compiled": "kompilovaný", "wrong": "chybný", "first": "první",
    "application": "aplikace", "import": "importovat", "export": "exportovat", "template": "šablona", "category": "kategorie",
}
TECHNICAL_TERMS = W(
    "api cpu gpu html css javascript python java sql xml json http https url uri ssh ftp smtp tcp udp ip dns vpn ssl tls oauth jwt crud mvc mvp mvvm rest soap "
    "graphql nosql mysql postgresql mongodb redis docker kubernetes aws azure gcp cdn seo cms crm erp saas paas iaas devops cicd git github gitlab blockchain "
    "cryptocurrency bitcoin ethereum nft defi dao smart contract token wallet ai ml nlp opencv tensorflow pytorch sklearn numpy pandas matplotlib jupyter sdk ide "
    "gui cli ui ux svg png jpg pdf zip tar gz"
)


def generic_words() -> list[str]:
    return sorted({*GENERIC_ACTIONS, *GENERIC_STATES, *GENERIC_UI, *GENERIC_SIZES, *COLORS, *GENERIC_TIMES, *GENERIC_NOUNS})


@dataclass(frozen=True)
class Lexicon:
    """Words that belong to a user: products, vendors, and the general word list of the dictionary."""

    product_names: tuple = ()
    brand_names: tuple = ("microsoft", "google", "apple", "intel", "amd", "nvidia")
    common_words: tuple = field(default_factory=lambda: tuple(sorted({*VERY_COMMON, *ADJECTIVES, *COLORS, *DIRECTIONS})))
    technical_terms: tuple = tuple(TECHNICAL_TERMS)


DEFAULT = Lexicon()
