"""Fixed values the results depend on."""

# Band thresholds, score floor and bonus.
HIGH_CLASSES = 3
MEDIUM_CLASSES = 2
HIGH_SCORE_FLOOR = 90.0
PRIOR_LEVEL = 5
PRIOR_BONUS = 0.15
UNVOUCHED_FACTOR = 0.2
RECENCY_FLOOR = 0.2

# Severity per category.
CATEGORY_SEVERITY = {
    "botnet-c2": 1.0,
    "malware-infrastructure": 1.0,
    "hijacked-netblock": 1.0,
    "criminal-hosting": 1.0,
    "malicious-tls": 0.9,
    "web-attack": 0.8,
    "brute-force": 0.7,
    "ssh-attack": 0.7,
    "scanning": 0.6,
    "reported-abuse": 0.7,
    "spam-source": 0.5,
    "abuse": 0.5,
}
DEFAULT_SEVERITY = 0.6

# Tags and sources with a meaning of their own.
EXIT_TAG = "tor-exit"
COMPROMISED_TAG = "compromised-host"
LEVEL_TAG_PREFIX = "ipsum-level-"
NETBLOCK_SOURCES = ("spamhaus_drop_v4", "spamhaus_drop_v6")
PROMOTING_CLASS = "abusech"

# Widest prefix published, per family.
WIDEST_V4 = 22
WIDEST_V6 = 48

# Disclosure control and statistics.
MIN_CELL = 5
MAX_ENTRY_WEIGHT = 1 << 24
MAX_NETWORK_WEIGHT = 1024
SPECTRUM_BUCKETS = 512
HISTORY_DAYS = 90
WINDOW_DAYS = (30, 60)
MIN_ANNOUNCED = 256
TOP_NETWORKS = 25
TOP_OVERLAPS = 20
TOP_PER_WINDOW = 10

# Run guards.
CHURN_LIMIT = 0.25
STALENESS_DAYS = 30
DEFAULT_TTL_DAYS = 14
HISTORY_RUNS = 720

# Payload tag vocabulary -> category.
TAG_CATEGORIES = {
    "telnet": "brute-force",
    "ssh": "ssh-attack",
    "http": "web-attack",
    "https": "web-attack",
    "ftp": "brute-force",
    "smtp": "spam-source",
    "haas": "ssh-attack",
    "portscan": "scanning",
}

# Address space that is never published (IANA special-purpose registries
# as the Python 3.13 standard library lists them).
V4_PRIVATE = (
    "0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12",
    "192.0.0.0/24", "192.0.0.170/31", "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15",
    "198.51.100.0/24", "203.0.113.0/24", "240.0.0.0/4", "255.255.255.255/32",
)
V4_PRIVATE_EXCEPT = ("192.0.0.9/32", "192.0.0.10/32")
V4_RESERVED = ("240.0.0.0/4",)
V4_MULTICAST = ("224.0.0.0/4",)
V6_PRIVATE = (
    "::1/128", "::/128", "::ffff:0:0/96", "64:ff9b:1::/48", "100::/64", "2001::/23",
    "2001:db8::/32", "2002::/16", "fc00::/7", "fe80::/10",
)
V6_PRIVATE_EXCEPT = (
    "2001:1::1/128", "2001:1::2/128", "2001:3::/32", "2001:4:112::/48", "2001:20::/28",
    "2001:30::/28",
)
V6_RESERVED = (
    "::/8", "100::/8", "200::/7", "400::/6", "800::/5", "1000::/4", "4000::/3", "6000::/3",
    "8000::/3", "a000::/3", "c000::/3", "e000::/4", "f000::/5", "f800::/6", "fe00::/9",
)
V6_MULTICAST = ("ff00::/8",)

# What stands for a network or country that no range names.
UNKNOWN_NETWORK = "unrouted or unknown"
UNKNOWN_COUNTRY = "??"

# Names of the analyses that may be without signal.
FLAT_CLASSES = "Corroboration histogram"
FLAT_SCORES = "Score distribution"
FLAT_BANDS = "Band split"
FLAT_CHANGES = "Added and removed each run"
FLAT_CATEGORIES = "Category breakdown"
FLAT_NETWORKS = "Network and ASN persistence"

#: Indicators named in a document per change.
DELTA_EXAMPLES = 20
#: Runs shown side by side.
SHOWN_RUNS = 40
