"""Word lists that decide what counts as noise, a bank, a suffix or a city.

Every list here is a fixed value: results depend on exactly these words.
"""

# Bank names removed from narrations.
BANKS = [
    "hdfc bank", "hdfc", "icici bank", "icici", "sbi", "state bank of india",
    "axis bank", "axis", "kotak mahindra bank", "kotak", "yes bank",
    "indusind bank", "indusind", "federal bank", "idfc first bank", "idfc first bank ltd", "idfc",
    "rbl bank", "karur vysya bank", "south indian bank", "city union bank",
    "union bank", "union bank of india", "punjab national bank", "pnb",
    "bank of baroda", "bob", "canara bank", "indian bank", "central bank",
    "bank of india", "boi", "oriental bank", "corporation bank",
    "andhra bank", "allahabad bank", "syndicate bank", "vijaya bank",
    "dena bank", "indian overseas bank", "iob", "uco bank",
    "central bank of india", "cbi", "punjab and sind bank",
    "standard chartered", "standard chart", "citibank", "citi bank",
    "deutsche bank", "hsbc", "barclays", "american express",
    "idbi bank", "idbi", "karnataka bank", "tamilnad mercantile bank",
    "lakshmi vilas bank", "lvb", "dhanlaxmi bank", "nainital bank",
    "jana small finance bank", "equitas small finance bank",
    "ujjivan small finance bank", "au small finance bank",
    "capital small finance bank", "esaf small finance bank",
    "fincare small finance bank", "north east small finance bank",
    "suryoday small finance bank", "utkarsh small finance bank",
    "bandhan bank", "paytm payments bank", "airtel payments bank",
    "india post payments bank", "fino payments bank", "jio payments bank",
    "nsdl payments bank", "aditya birla idea payments bank",
]

# Payment-channel phrases removed from narrations.
NOISE_PHRASES = [
    "neft", "rtgs", "imps", "upi", "ach", "nach", "ecs", "swift",
    "wire", "transfer", "inb", "ift", "clg", "htr", "domneft",
    "paid to", "payment to", "transfer to", "remittance",
    "tparty transfer", "party transfer", "emi",
]

# Company words kept by the short-word filter.
COMPANY_SUFFIXES = [
    "pvt", "private", "ltd", "limited", "inc", "corp", "co", "company",
    "enterprises", "industries", "services", "solutions", "technologies",
    "systems", "motors", "textiles", "traders", "exports", "imports",
]

# Words deleted by name normalisation.
LEGAL_WORDS = ["pvt", "private", "ltd", "limited", "inc", "corp", "co"]
ARTICLES = ["the", "a", "an"]

# Channel names stripped from the front of a text before locating.
CHANNEL_PREFIXES = [
    "neft", "rtgs", "imps", "upi", "ach", "nach", "ecs", "swift", "wire", "transfer",
]

# Endings that mark a word as a place name.
LOCATION_SUFFIXES = [
    "nagar", "pur", "bad", "ganj", "gram", "puram", "patnam", "kota",
    "ville", "pally", "wadi", "garh", "kot", "gunj", "tola", "para",
    "salem", "coimbatore", "madurai", "trichy", "kanchipuram",
    "ramanathapuram", "tirunelveli", "vellore", "thanjavur",
]

# Cities looked for anywhere in a text.
MAJOR_CITIES = [
    "chennai", "mumbai", "delhi", "bangalore", "bengaluru", "hyderabad",
    "pune", "kolkata", "ahmedabad", "surat", "jaipur", "lucknow",
    "kanpur", "nagpur", "indore", "thane", "bhopal", "visakhapatnam",
    "patna", "vadodara", "ghaziabad", "ludhiana", "agra", "nashik",
    "kochi", "cochin", "madurai", "coimbatore", "trichy", "salem",
    "tirunelveli", "vellore", "thanjavur", "kanchipuram", "kancheepuram",
    "ramanathapuram", "tiruchirappalli", "tiruchirapalli",
]

# Column names tried, in this order, for the narration.
NARRATION_COLUMNS = ["Narration", "Description", "Transaction", "Details", "Memo"]


def longest_first(phrases: list[str]) -> list[str]:
    """Order in which a regex alternation tries overlapping phrases."""
    return sorted(phrases, key=lambda p: (-len(p), p))


def phrases_of(phrases: list[str], words: int) -> list[str]:
    return [p for p in phrases if p.count(" ") + 1 == words]
