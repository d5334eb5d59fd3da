"""Words, thresholds and tables that results depend on, as they must be for equal results."""

from __future__ import annotations

# --- presence, names ---

PLACEHOLDERS = ("", "none", "null", "n/a", "na", "unknown", "לא ידוע", "غير معروف")
#: Romanised words that describe a person and don't name one.
DESCRIPTORS = ("lshb", "lfty", "lmrhwm", "lmghdwr", "ldhyh", "lqtyl")
HONORIFICS = ("الشهيد", "المرحوم", "المغفور له", "الحاج", 'ז"ל', 'הי"ד', "ר'", "רב")
ARABIC_ROMAN_NAMES = {
    "بكر": "BAKR", "أبو": "ABU", "ابو": "ABU", "محمد": "MOHAMMED", "محمود": "MAHMOUD", "أحمد": "AHMED", "احمد": "AHMED",
    "علي": "ALI", "حسن": "HASSAN", "حسين": "HUSSEIN", "ياسين": "YASSIN", "خالد": "KHALED", "إبراهيم": "IBRAHIM", "ابراهيم": "IBRAHIM",
    "عمر": "OMAR", "يوسف": "YUSUF", "موسى": "MUSA", "عيسى": "ISA", "كريم": "KARIM", "سالم": "SALEM", "سامي": "SAMI", "وليد": "WALEED",
    "سعيد": "SAEED", "نور": "NUR", "أمين": "AMIN", "نصّار": "NASSAR", "نصار": "NASSAR", "عاصلة": "ASLA", "شلاعطة": "SHLAATA",
    "دكّة": "DAKKA", "دكة": "DAKKA", "أبو سالم": "ABU-SALEM", "أبو سلام": "ABU-SALAM", "اغبارية": "AGBARIA", "عجبارية": "AGBARIA",
    "جبارين": "JABARIN", "خطيب": "KHATIB", "حلايقة": "HALAYQA", "زبيدات": "ZBEIDAT", "صرصور": "SARSUR", "حلبي": "HALABI",
}
ARABIC_TO_HEBREW = {
    "ا": "א", "أ": "א", "إ": "א", "آ": "א", "ٱ": "א", "ب": "ב", "ت": "ת", "ث": "ת", "ج": "ג'", "ح": "ח", "خ": "ח'", "د": "ד", "ذ": "ד'", "ر": "ר",
    "ز": "ז", "س": "ס", "ش": "ש", "ص": "צ", "ض": "ד", "ط": "ט", "ظ": "ז'", "ع": "ע", "غ": "ע'", "ف": "פ", "ق": "ק", "ك": "כ", "ل": "ל", "م": "מ",
    "ن": "נ", "ه": "ה", "ة": "ה", "و": "ו", "ي": "י", "ى": "א", "ء": "", "ئ": "י", "ؤ": "ו",
}
HEBREW_TO_ARABIC = {
    "א": "ا", "ב": "ب", "ג": "ج", "ד": "د", "ה": "ه", "ו": "و", "ז": "ز", "ח": "ح", "ט": "ط", "י": "ي", "כ": "ك", "ך": "ك", "ל": "ل", "מ": "م", "ם": "م",
    "נ": "ن", "ן": "ن", "ס": "س", "ע": "ع", "פ": "ف", "ף": "ف", "צ": "ص", "ץ": "ص", "ק": "ق", "ר": "ر", "ש": "ش", "ת": "ت",
}
HEBREW_DIGRAPHS = {"ג'": "ج", "ז'": "ج", "ד'": "ذ", "ח'": "خ", "ע'": "غ", "צ'": "ض", "ת'": "ث"}

# --- sources ---

TIER_1 = {
    "ynet.co.il": "Ynet", "mako.co.il": "Mako", "n12.co.il": "Channel 12 / N12", "channel12.co.il": "Channel 12", "13tv.co.il": "Channel 13",
    "reshet.tv": "Channel 13", "haaretz.co.il": "Haaretz", "haaretz.com": "Haaretz English", "walla.co.il": "Walla", "news.walla.co.il": "Walla News",
    "israelhayom.co.il": "Israel Hayom", "kan.org.il": "Kan", "timesofisrael.com": "Times of Israel", "jpost.com": "Jerusalem Post",
    "calcalist.co.il": "Calcalist", "globes.co.il": "Globes", "maariv.co.il": "Maariv", "inn.co.il": "Arutz Sheva", "ynetnews.com": "Ynetnews",
    "emess.co.il": "EMess",
}
TIER_2 = {
    "arab48.com": "Arab48", "makan.org.il": "Makan", "panet.com": "Panet", "kul-alarab.com": "Kul al-Arab", "bokra.net": "Bokra", "alarab.com": "Al-Arab",
    "alaraby.co.uk": "Al-Araby", "shfanews.com": "Shfa News", "shams.fm": "Shams FM", "raya.ps": "Raya",
}
TIER_3 = {
    "police.gov.il": "Israel Police", "knesset.gov.il": "Knesset", "court.gov.il": "Israeli Courts", "justice.gov.il": "Ministry of Justice",
    "gov.il": "Government of Israel", "cbs.gov.il": "Central Bureau of Statistics",
}
#: An official page counts only if its URL holds one of these and none of the others.
OFFICIAL_PATHS = ("/pressreleases/", "/press-releases/", "/press/", "/news/", "/announcements/", "/cases/", "/indictment", "/court_decisions/", "/decisions/", "/judgments/")
OFFICIAL_JUNK = ("rights%20guide", "rights-guide", "rightsguide", "/forms/", "/faq", "/about", "/contact", "/zchuyot", "/zchooyot")
PUBLISHERS = {
    "haaretz.co.il": "Haaretz", "ynet.co.il": "Ynet", "mako.co.il": "Mako", "n12.co.il": "N12", "walla.co.il": "Walla!", "kan.org.il": "Kan",
    "maariv.co.il": "Maariv", "globes.co.il": "Globes", "calcalist.co.il": "Calcalist", "inn.co.il": "Arutz Sheva", "police.gov.il": "Israel Police",
    "panet.com": "Panet", "bokra.net": "Bokra", "arab48.com": "Arab48", "alarab.com": "Al-Arab", "emess.co.il": "EMess", "13tv.co.il": "Channel 13",
    "reshet.tv": "Channel 13", "haaretz.com": "Haaretz English", "timesofisrael.com": "Times of Israel", "jpost.com": "Jerusalem Post",
}
#: Tiers of a field in order of trust; others are trusted in order 1, 2, 3.
FIELD_TIERS = {
    "legal_status": (3, 1, 2), "police_investigation_status": (3, 1, 2), "suspect_status": (3, 1, 2), "court_case_id": (3, 1, 2),
    "incident_date": (1, 3, 2), "death_date": (1, 3, 2), "victim_age": (1, 2, 3), "victim_gender": (1, 2, 3), "weapon_type": (1, 3, 2),
    "weapon_subtype": (1, 2, 3), "num_victims": (1, 3, 2), "victim_name_ar": (2, 1, 3), "victim_aliases": (2, 1, 3), "victim_profession": (2, 1, 3),
    "victim_residence": (2, 1, 3), "neighborhood": (2, 1, 3), "exact_place_type": (2, 1, 3), "community_context": (2, 1, 3), "media_items": (2, 1, 3),
    "hospital": (1, 2, 3), "suspect_name": (1, 2, 3), "suspect_relation": (2, 1, 3), "suspect_profession": (2, 1, 3), "arrest_location": (1, 2, 3),
}
PUBLISHER_WEIGHTS = {"police": 3, "ynet": 2, "kan": 2, "haaretz": 2, "panet": 1, "bokra": 1}

# --- places ---

DISTRICTS = {
    "צפון": "Northern District", "Northern": "Northern District", "Northern District": "Northern District", "מחוז הצפון": "Northern District", "الشمال": "Northern District",
    "מרכז": "Central District", "Central": "Central District", "Central District": "Central District", "מחוז המרכז": "Central District",
    "דרום": "Southern District", "Southern": "Southern District", "Southern District": "Southern District", "מחוז הדרום": "Southern District",
    "חיפה": "Haifa District", "Haifa": "Haifa District", "Haifa District": "Haifa District", "תל אביב": "Tel Aviv District", "Tel Aviv": "Tel Aviv District",
    "ירושלים": "Jerusalem District", "Jerusalem": "Jerusalem District", "יהודה ושומרון": "Judea and Samaria",
}
REGIONS = {
    "גליל": "Galilee", "הגליל": "Galilee", "גליל עליון": "Upper Galilee", "גליל תחתון": "Lower Galilee", "Galilee": "Galilee", "الجليل": "Galilee",
    "נגב": "Negev", "Negev": "Negev", "النقب": "Negev", "שרון": "Sharon", "Sharon": "Sharon", "כרמל": "Carmel", "Carmel": "Carmel",
    "עמק": "The Valleys", "Jordan Valley": "Jordan Valley", "בקעת הירדן": "Jordan Valley",
}
#: Cultural regions of towns.
TOWN_REGIONS = {
    "galilee": (
        "Arraba", "Sakhnin", "Deir Hanna", "Majd al-Krum", "Tamra", "Shfaram", "Kafr Kanna", "Nazareth", "Kafr Manda", "Iksal", "Yafa an-Naseriyye", "Reineh",
        "Kafr Yasif", "Maghar", "Bi'ina", "Nahf", "Rameh", "Kabul", "I'billin", "Tur'an", "Kawkab Abu al-Hija", "Yarka", "Arab al-Aramshe", "Yanuh-Jat", "Fureidis",
    ),
    "triangle": ("Umm al-Fahm", "Baqa al-Gharbiyye", "Jatt", "Ar'ara", "Kafr Qara", "Tira", "Taybe", "Qalansawe", "Jaljulia", "Kafr Qasim"),
    "negev": ("Rahat", "Hura", "Tel Sheva", "Lakiya", "Ksaifa", "Beersheba", "Shaqib al-Salam"),
    "mixed": ("Lod", "Ramla", "Tel Aviv", "Jaffa", "Jerusalem", "Beit Safafa", "Abu Ghosh", "Haifa", "Pardes Hanna-Karkur", "Acre"),
}

# --- titles ---

ROLLUP_MARKERS = ("قتيلا منذ", "قتيلا عربيا", "ضحية هذا العام", "حصيلة القتلى", "מתחילת השנה", "הרוגים מתחילת")
ROLLUP_TITLE = r"\d+\s*(?:قتيلا|ضحية|נרצחים|הרוגים)"
INJURY_MARKERS = ("פצוע", "נפצע", "פציעה", "נפצעה", "נער נפצע", "אישה נפצעה", "إصابة", "أصيب", "أصيبت", "إصابات", "أُصيب", "بجراح")
FOLLOWUP_MARKERS = ("السجن", "حبس", "لائحة اتهام", "اعتقال", "تمديد", "محكمة", "إدانة", "استئناف", "النيابة")
NAME_AND_CITY = r"(?:مقتل|قتل|وفاة|استشهاد)\s+(\S+(?:\s+\S+){0,3})\s+(?:من|في|قرب)\s+(\S+)"
ALLOWED_GEOGRAPHY = ("israel_arab_society", "unknown")
HOMICIDE_TYPES = ("homicide", "attempted_homicide")
OTHER_TYPES = ("accident", "suicide", "historical", "other_crime", "non_crime")
SURVIVED = ("ששרד", "שרד את", "נפצע ושרד", "נורה ושרד", "نجا من", "لم يُقتل", "أُصيب ولم يُقتل")
INJURED = (
    "נפצע", "נפצעו", "פצוע", "פצועים", "מצבו בינוני", "מצבו קשה", "מצבם בינוני", "מצבם קשה", "הועבר לבית החולים", "הועברו לבית החולים",
    "أصيب", "أُصيب", "أصيبوا", "جريح", "جرحى",
)
DIED = (
    "נרצח", "נרצחה", "נרצחו", "נהרג", "נהרגה", "נהרגו", "מת מפצעיו", "מתה מפצעיה", "נקבע מותו", "מותו נקבע", "למותו",
    "لقي حتفه", "لقيت حتفها", "قُتل", "قتلت", "مقتل", "توفي", "توفيت",
)
BACKGROUND = ("בני אדם", "קורבנות", "בחודש", "מתחילת השנה", "בשנת", "בחברה הערבית", "לפי נתוני", "על פי נתוני", "اشخاص", "ضحايا", "منذ بداية العام")

# --- media ---

CATEGORY_WORDS = {
    "victim_portrait": [
        "victim", "deceased", "killed", "the late", "קרבן", 'ז"ל', "המנוח", "הנרצח", "הצעיר שנרצח",
        "الضحية", "المرحوم", "القتيل", "الراحل", "ضحية", "قتيل", "شهيد", "مغدور",
    ],
    "suspect_portrait": ["suspect", "accused", "alleged", "חשוד", "הנאשם", "המעורב", "المشتبه", "المتهم", "الجاني"],
    "crime_scene": [
        "scene", "crime scene", "shooting site", "location of", "זירה", "זירת הרצח", "זירת הירי", "מקום האירוע",
        "موقع الجريمة", "مكان الحادث", "موقع إطلاق النار", "مكان الجريمة", "مسرح الجريمة", "من مكان",
    ],
    "weapon": ["weapon", "firearm", "gun", "handgun", "pistol", "knife", "נשק", "אקדח", "סכין", "سلاح", "مسدس", "بندقية", "سكين"],
    "court": [
        "court", "remand", "hearing", "indictment", "judge", "tribunal", "בית משפט", "הארכת מעצר", "כתב אישום", "השופט",
        "المحكمة", "تمديد اعتقال", "لائحة اتهام", "القاضي",
    ],
    "funeral": ["funeral", "burial", "mourners", "memorial", "הלוויה", "לוויה", "אבל", "מצבה", "جنازة", "تشييع", "دفن", "العزاء"],
    "cctv": [
        "cctv", "security camera", "surveillance footage", "מצלמות אבטחה", "תיעוד מהמצלמות", "מצלמת אבטחה",
        "كاميرات المراقبة", "كاميرا أمنية", "تسجيل المراقبة",
    ],
    "police_activity": [
        "police", "officers", "investigation", "crime tape", "patrol", "משטרה", "שוטרים", "סרט אזהרה", "חקירה",
        "الشرطة", "الضابط", "الشريط الأمني", "التحقيق",
    ],
    "generic_stock": [
        "illustration", "for illustration", "file photo", "stock photo", "אילוסטרציה", "ארכיון", "צילום אילוסטרציה",
        "للتوضيح", "أرشيف", "صورة من الأرشيف",
    ],
}
MEANINGFUL = ("victim_portrait", "suspect_portrait", "crime_scene", "weapon", "police_activity", "court", "funeral", "cctv")
PERSON_MARKERS = (
    "victim", "deceased", "the late", "killed", "המנוח", "הנרצח", "הקורבן", "ז״ל", 'ז"ל',
    "المرحوم", "المغدور", "الضحية", "ضحية", "الشهيد", "الراحل", "القتيل", "قتيل", "ضحيّتا", "ضحيتا",
)
LOCATION_MARKERS = (
    "crime scene", "shooting scene", "shooting site", "scene of the crime", "זירת הרצח", "זירת הירי", "מקום האירוע", "זירה",
    "موقع الجريمة", "مكان الجريمة", "موقع إطلاق النار", "مكان الحادث", "مسرح الجريمة",
)
#: What stands before the name of a photographer or reporter.
CREDIT = (
    r"(?i)(?:photo(?:graph(?:er)?)?(?:\s+by)?[\s:]*|צילום\s*[:\-]?|תצלום\s*[:\-]?|תמונה\s*[:\-]?|כתב\s*[:\-]|מאת\s*[:\-]?|כתבת?\s*[:\-]|תחקיר\s*[:\-]"
    r"|تصوير\s*[:\-]?|مصور\s*[:\-]?|كاميرا\s*[:\-]?|©\s*|by\s+|reporter\s*[:\-]?)"
)
RELATIONS = (
    "جد", "جدة", "والد", "والدة", "أب", "أم", "أخ", "أخت", "شقيق", "شقيقة", "ابن", "ابنة", "نجل", "نجلة", "زوج", "زوجة", "أرملة", "عم", "عمة", "خال", "خالة",
)
VICTIM_WORDS = ("القتيل", "الضحية", "المرحوم", "الراحل", "الشهيد", "قتيل", "ضحية", "شهيد", "مغدور")
STOCK_DOMAINS = ("gettyimages.", "shutterstock.", "istockphoto.", "depositphotos.", "alamy.", "stock.adobe.", "ap.org", "afp.com", "reuters.com/file")
STOCK_MARKERS = (
    "אילוסטרציה", "ארכיון", "צילום אילוסטרציה", "אין קשר לכתבה", "למצולמים אין קשר לכתבה", "לצילום אין קשר לכתבה",
    "للتوضيح", "أرشيف", "صورة من الأرشيف", "لا علاقة للصورة", "لا علاقة لهم بالخبر", "الصورة للتوضيح",
    "illustration", "file photo", "stock photo", "for illustration",
)
BLOCKED_URLS = (
    "/icons/", "/avatar/", "/avatars/", "/logo", "/favicon", "1x1.gif", "pixel.png", "spacer.gif", "blank.gif", "/social-icons/", "/share-icons/", "/tracking/",
    "/ads/", "/sponsor/", "/author/", "/authors/", "/reporter/", "/reporters/", "/staff/", "/journalist/", "/journalists/", "/contributor/", "/contributors/",
    "trc.taboola.com", "/cdn-cgi/l/email-protection", "facebook.com/tr", "connect.facebook.net", "google-analytics.com", "googletagmanager.com",
    "doubleclick.net", "outbrain.com/loader", "amplitude.com", "?ev=pageview", "&ev=pageview", "noscript=1", "/beacon", "/pixel.gif", "/p.gif", "/log?", "/log/", "/collect?",
)
PER_ARTICLE, PER_CASE, VISION_CALLS = 20, 80, 15
KEYWORD_ENOUGH, PROMPT_ENOUGH = 0.7, 0.35
IMAGE_COSINE = 0.92
#: Letters that captions fold, and marks that they lose.
FOLD_FROM, FOLD_TO = "أإآىةؤئ", "ااايهوي"
CAPTION_MARKS = r"[ؐ-ًؚ-ٰٟۖ-ۭ]"

#: Parts of the paths of one site's images that belong to a story, and those that never do; words of a caption about an incident.
SITE_IMAGES = ("/facebook_watermark/", "/bodyimages/images/", "/841-494/")
SITE_THUMBNAILS = ("/280-211/", "/assets/", ".svg")
INCIDENT_WORDS = ("موقع الجريمة", "مكان الجريمة", "موقع إطلاق النار", "مكان الحادث", "مسرح الجريمة", "المرحوم", "المغدور", "الضحية", "القتيل")

# --- searches ---

#: Searches by tier, in order; one whose fields aren't all known is left out.
SEARCHES = {
    "mainstream": (
        'site:ynet.co.il "{he}"', 'site:mako.co.il "{he}"', 'site:haaretz.co.il "{he}"', 'site:walla.co.il "{he}"', 'site:israelhayom.co.il "{he}"',
        'site:n12.co.il "{he}"', 'site:kan.org.il "{he}"', '"{city}" רצח {year}',
    ),
    "arabic_local": (
        'site:arab48.com "{ar}"', 'site:panet.com "{ar}"', 'site:kul-alarab.com "{ar}"', 'site:bokra.net "{ar}"', 'site:alarab.com "{ar}"',
        'site:arab48.com "{city_ar}" قتل', 'site:panet.com "{city_ar}" جريمة', "site:kul-alarab.com {ar} {city_ar}", "site:arab48.com {ar}{city_ar?} جنازة",
    ),
    "official": (
        'site:police.gov.il רצח "{he}"{city?}', 'site:police.gov.il "{city}" רצח{he?}', 'site:gov.il "{he}"{city?}', "site:police.gov.il {city_ar} {ar}",
        'site:court.gov.il "{he}"', '"{he}" כתב אישום משטרה',
    ),
    "arabic": (
        "جريمة قتل {city_ar} {year}", "مقتل {city_ar} {year}", "إطلاق نار {city_ar}", "ضحية {city_ar}", "جنازة {city_ar}", "تشييع {city_ar}", "وادي {city_ar}", "{city_en} ضحية",
    ),
}

# --- views ---

MONTHS = {
    "ar": ("يناير", "فبراير", "مارس", "أبريل", "مايو", "يونيو", "يوليو", "أغسطس", "سبتمبر", "أكتوبر", "نوفمبر", "ديسمبر"),
    "he": ("ינואר", "פברואר", "מרץ", "אפריל", "מאי", "יוני", "יולי", "אוגוסט", "ספטמבר", "אוקטובר", "נובמבר", "דצמבר"),
}
SUMMARY_FIELDS = (
    "victim_name", "victim_name_ar", "victim_name_he", "victim_age", "victim_gender", "victim_outcome", "incident_date", "city", "district",
    "weapon_type", "suspect_status", "legal_status", "confidence_score", "review_status",
)
PER_VICTIM = ("victim_name", "victim_name_ar", "victim_name_he", "victim_name_en", "victim_age", "victim_gender", "city", "incident_date", "victim_outcome")
