"""Word lists and lookup tables used as defaults.

Every operator takes its dictionary as a parameter; these are the defaults.
"""

# --- Fixed values: category keywords, in tie-breaking order.
CATEGORY_KEYWORDS = {
    "Technology": (
        "ai", "software", "tech", "data", "cyber",
        "apple", "google", "microsoft", "app", "chip",
    ),
    "Business": (
        "market", "stock", "economy", "bank",
        "revenue", "profit", "trade", "investment",
    ),
    "Politics": (
        "election", "government", "president", "law",
        "minister", "parliament", "policy", "vote",
    ),
    "Sports": (
        "match", "league", "player", "tournament",
        "stadium", "score", "champion", "football",
    ),
}

# --- Fixed values: longer documented keyword lists.
CATEGORY_KEYWORDS_LONG = {
    "Technology": CATEGORY_KEYWORDS["Technology"] + ("cloud", "algorithm", "neural"),
    "Business": CATEGORY_KEYWORDS["Business"] + ("ceo", "earnings", "nasdaq", "fortune"),
    "Politics": CATEGORY_KEYWORDS["Politics"] + ("senate", "congress", "bill"),
    "Sports": CATEGORY_KEYWORDS["Sports"] + ("basketball", "soccer", "nfl", "nba"),
}

# --- Fixed values: words never reported as keywords.
STOP_WORDS = (
    "the", "and", "for", "with", "into", "from",
    "that", "this", "have", "will", "about",
)
STOP_WORDS_LONG = STOP_WORDS + ("are", "been", "was", "is", "not")

# --- Fixed values: query words that name a category, in matching order.
QUERY_TERMS = {
    "Technology": ("technology", "tech", "artificial intelligence", "ai"),
    "Politics": ("politics", "political", "election", "government"),
    "Sports": ("sports", "sport", "football", "soccer", "cricket", "tennis"),
    "Business": ("business", "economy", "economic", "market", "finance"),
}

# --- Fixed values: display attributes.
CATEGORY_COLORS = {
    "Technology": "blue",
    "Business": "red",
    "Politics": "orange",
    "Sports": "green",
    "General": "gray",
}
SENTIMENT_MARKERS = {"Positive": "😊", "Negative": "😞", "Neutral": "😐"}

# --- Fixed values: frequent function words per language.
FUNCTION_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "was", "by", "are", "this", "on"),
    "fr": ("le", "la", "les", "de", "des", "et", "un", "une", "est", "que", "qui", "dans", "pour", "sur", "du"),
    "de": ("der", "die", "das", "und", "ist", "nicht", "ein", "eine", "den", "von", "mit", "zu", "auf", "für", "dem"),
    "es": ("el", "la", "los", "las", "de", "y", "en", "que", "por", "una", "con", "para", "es", "del", "no"),
}

# --- Fixed values: place names of the default gazetteer, lower case.
COUNTRIES = (
    "argentina", "australia", "austria", "bangladesh", "belgium", "brazil", "canada",
    "chile", "china", "colombia", "croatia", "cuba", "denmark", "egypt", "ethiopia",
    "finland", "france", "germany", "greece", "hungary", "iceland", "india",
    "indonesia", "iran", "iraq", "ireland", "israel", "italy", "japan", "kenya",
    "malaysia", "mexico", "morocco", "netherlands", "new zealand", "nigeria",
    "norway", "pakistan", "peru", "philippines", "poland", "portugal", "romania",
    "russia", "saudi arabia", "singapore", "south africa", "south korea", "spain",
    "sweden", "switzerland", "thailand", "turkey", "ukraine", "united kingdom",
    "united states", "vietnam",
)
CITIES = (
    "amsterdam", "athens", "austin", "bangkok", "barcelona", "beijing", "berlin",
    "boston", "brussels", "budapest", "buenos aires", "cairo", "chicago",
    "copenhagen", "delhi", "dubai", "dublin", "geneva", "hong kong", "houston",
    "istanbul", "jakarta", "johannesburg", "karachi", "lagos", "lima", "lisbon",
    "london", "los angeles", "madrid", "manchester", "manila", "melbourne",
    "mexico city", "miami", "milan", "moscow", "mumbai", "munich", "nairobi",
    "new york", "osaka", "oslo", "paris", "prague", "rome", "san francisco",
    "santiago", "seattle", "seoul", "shanghai", "stockholm", "sydney", "tokyo",
    "toronto", "vancouver", "vienna", "warsaw", "washington", "zurich",
)
GAZETTEER = COUNTRIES + CITIES

# --- Fixed values: cues of the entity tagger.
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July", "August",
    "September", "October", "November", "December",
)
WEEKDAYS = (
    "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
)
LEADING_WORDS = (
    "The", "A", "An", "In", "On", "At", "By", "Of", "And", "But", "For", "From",
    "To", "With", "This", "That", "It", "Is", "As", "Or", "If", "When", "While",
)
LOCATION_HEADS = (
    "Valley", "River", "Sea", "Ocean", "Mountains", "Mountain", "Lake", "Island",
    "Islands", "Desert", "Bay", "Coast", "Forest", "Rainforest", "Peninsula",
)
EVENT_HEADS = (
    "War", "Cup", "Olympics", "Games", "Festival", "Championship", "Summit",
)
ORGANIZATION_HEADS = (
    "Inc", "Corp", "Corporation", "Ltd", "LLC", "University", "Bank", "Ministry",
    "Party", "Group", "Company", "Council", "Agency", "Commission", "Nations",
    "Union", "Association", "Institute", "Foundation", "Committee",
)
ORGANIZATIONS = (
    "amazon", "apple", "facebook", "google", "ibm", "intel", "meta", "microsoft",
    "netflix", "nvidia", "openai", "reuters", "samsung", "sony", "tesla", "toyota",
)

# --- Fixed values: word valences on the -4..4 scale of Hutto & Gilbert (2014).
VALENCES = {
    "amazing": 2.8, "awesome": 3.1, "beautiful": 2.9, "benefit": 2.0, "best": 3.2,
    "better": 1.9, "boost": 1.7, "breakthrough": 1.9, "bright": 1.9,
    "calm": 1.3, "celebrate": 2.7, "champion": 2.9, "confident": 2.2,
    "delight": 2.9, "easy": 1.9, "encourage": 2.3, "enjoy": 2.2, "excellent": 2.7,
    "excited": 1.4, "fantastic": 2.6, "favorite": 2.0, "fine": 0.8, "free": 2.3,
    "friendly": 2.2, "fun": 2.3, "gain": 2.4, "good": 1.9, "great": 3.1,
    "growth": 1.6, "happy": 2.7, "help": 1.7, "helpful": 1.8, "hope": 1.9,
    "impressive": 2.3, "improve": 1.9, "improved": 2.1, "innovation": 1.6,
    "innovative": 1.9, "joy": 2.8, "like": 1.5, "love": 3.2, "loved": 2.9,
    "lucky": 1.8, "nice": 1.8, "peace": 2.5, "perfect": 2.7, "pleased": 1.9,
    "positive": 2.6, "profit": 1.9, "progress": 1.8, "promise": 1.3,
    "prosperity": 2.6, "safe": 1.9, "secure": 1.4, "smart": 1.7, "smile": 1.5,
    "strength": 2.2, "strong": 2.3, "success": 2.7, "successful": 2.8,
    "superb": 3.1, "support": 1.7, "thank": 1.5, "thanks": 1.9, "triumph": 2.1,
    "trust": 2.3, "useful": 1.9, "victory": 2.8, "win": 2.8, "winner": 2.8,
    "wonderful": 2.7, "worth": 0.9,
    "abuse": -3.2, "afraid": -2.2, "alarm": -1.4, "anger": -2.7, "angry": -2.3,
    "attack": -2.1, "awful": -2.0, "bad": -2.5, "battle": -1.6, "blame": -1.4,
    "bomb": -2.2, "broken": -2.1, "collapse": -2.2, "concern": -0.6, "conflict": -1.3,
    "corrupt": -2.9, "crash": -1.7, "crashed": -1.7, "crime": -2.5, "crisis": -3.1,
    "critical": -1.3, "cruel": -2.8, "damage": -2.2, "danger": -2.4,
    "dangerous": -2.1, "dead": -3.3, "death": -2.9, "decline": -1.3, "defeat": -2.0,
    "delay": -1.3, "destroy": -2.5, "disaster": -3.1, "doubt": -1.5, "error": -1.7,
    "fail": -2.5, "failed": -2.3, "failure": -2.3, "fake": -2.1, "fear": -2.2,
    "fight": -1.6, "fraud": -2.8, "guilty": -1.8, "hate": -2.7, "horrible": -2.5,
    "hurt": -2.4, "illegal": -2.6, "injury": -1.8, "kill": -3.7, "killed": -3.5,
    "lose": -1.7, "loss": -1.3, "lost": -1.3, "murder": -3.7, "negative": -2.7,
    "no": -1.2, "pain": -2.3, "panic": -2.3, "poor": -2.1, "problem": -1.7,
    "protest": -1.0, "risk": -1.1, "sad": -2.1, "scandal": -1.9, "shock": -1.6,
    "sick": -2.3, "stupid": -2.4, "terrible": -2.1, "terror": -2.4, "threat": -2.4,
    "tragedy": -3.4, "ugly": -2.3, "violence": -3.1, "war": -2.9, "warning": -1.4,
    "weak": -1.9, "worse": -2.1, "worst": -3.1, "wrong": -2.1,
}

# --- Fixed values: degree words (+ strengthens, - weakens) and negations.
STRENGTHENERS = (
    "absolutely", "completely", "considerably", "deeply", "enormously", "entirely",
    "especially", "extremely", "greatly", "highly", "hugely", "incredibly",
    "more", "most", "particularly", "really", "remarkably", "so", "totally",
    "tremendously", "unbelievably", "very",
)
WEAKENERS = (
    "almost", "barely", "hardly", "kinda", "less", "little", "marginally",
    "occasionally", "partly", "scarcely", "slightly", "somewhat",
)
NEGATIONS = (
    "aint", "arent", "cannot", "cant", "couldnt", "didnt", "doesnt", "dont",
    "hadnt", "hasnt", "havent", "isnt", "neither", "never", "none", "nope", "nor",
    "not", "nothing", "nowhere", "shouldnt", "wasnt", "werent", "without", "wont",
    "wouldnt", "rarely", "seldom", "despite",
)

# --- Fixed values: named character references that are decoded in page text.
HTML_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ",
    "&copy;": "©", "&reg;": "®", "&middot;": "·", "&ndash;": "–", "&mdash;": "—",
    "&lsquo;": "‘", "&rsquo;": "’", "&ldquo;": "“", "&rdquo;": "”",
    "&hellip;": "…", "&euro;": "€", "&pound;": "£",
}
