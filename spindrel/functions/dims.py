"""Constant dimensions and pattern lists.

All values in this module are fixed: results depend on them as they stand.
"""

from __future__ import annotations

# ---- fixed values: projects (sheet, id, name, kind, status)
PROJECTS = [
    ("VORON 2.4", "voron-2.4", "VORON 2.4", "printer", "current"),
    ("VORON Trident", "voron-trident", "VORON Trident", "printer", "current"),
    ("VORON 0.2", "voron-0.2", "VORON 0.2", "printer", "current"),
    ("Voron Switchwire", "voron-switchwire", "VORON Switchwire", "printer", "current"),
    ("VORON Cascade", "voron-cascade", "VORON Cascade", "printer", "empty"),
    ("Voron Stealthburner", "stealthburner", "Stealthburner", "toolhead", "current"),
    ("VORON Optional Parts", "optional-parts", "Optional Parts", "addon", "current"),
    ("VORON Tools", "tools", "Tools", "addon", "current"),
    ("VORON Afterburner", "afterburner", "Afterburner", "toolhead", "legacy"),
    ("VORON M4", "voron-m4", "VORON M4", "printer", "legacy"),
    ("VORON Mobius 3dot1", "mobius-3.1", "Mobius 3.1", "extruder", "legacy"),
    ("VORON JetPack", "jetpack", "JetPack", "addon", "legacy"),
    ("VORON 0", "voron-0", "VORON 0", "printer", "legacy"),
    ("VORON 0.1", "voron-0.1", "VORON 0.1", "printer", "legacy"),
    ("VORON 1.8", "voron-1.8", "VORON 1.8", "printer", "legacy"),
    ("VORON 1.6.2", "voron-1.6.2", "VORON 1.6.2", "printer", "legacy"),
    ("VORON 2.2", "voron-2.2", "VORON 2.2", "printer", "legacy"),
]
# ---- fixed values: project id -> family
FAMILIES = {"voron-0": "v0", "voron-0.1": "v0", "voron-0.2": "v0", "voron-1.6.2": "v1", "voron-1.8": "v1", "voron-2.2": "v2", "voron-2.4": "v2"}
# ---- fixed values: vendor-column header -> role, and the order of roles
ROLES = {
    "recommended": "recommended",
    "alternative source": "alternative",
    "alternative source 2": "alternative",
    "alt source 2": "alternative",
    "budget source": "budget",
    "non- afiliate links": "non_affiliate",
    "prusa mk3(s) sourced": "prusa_salvage",
}
ROLE_ORDER = ["recommended", "alternative", "budget", "non_affiliate", "prusa_salvage", "unknown"]
# ---- fixed values: category spellings
CATEGORIES = {
    "misc.": "Misc", "misc": "Misc", "hot end": "Hotend", "hotend": "Hotend", "hardware": "Hardware", "fasteners": "Fasteners",
    "kit": "Kits", "kits": "Kits", "frame - tophat": "Frame", "controller - duet family": "Controller", "controller - skr family": "Controller",
    "controller": "Controller", "adxl optional": "Electronics", "vibration management": "Vibration Management", "extruder hardware": "Extruder",
    "extruder": "Extruder", "cable chain": "Cables", "pocketwatch": "Printed Parts", "spares": "Misc", "alternative": "Misc",
}
# ---- fixed values: host suffix, vendor id, display name
VENDORS = [
    ("s.click.aliexpress.com", "aliexpress", "AliExpress"), ("aliexpress.com", "aliexpress", "AliExpress"), ("aliexpress.us", "aliexpress", "AliExpress"),
    ("amzn.to", "amazon", "Amazon"), ("amazon.com", "amazon", "Amazon"), ("amazon.co.uk", "amazon-uk", "Amazon UK"), ("amazon.de", "amazon-de", "Amazon DE"),
    ("amazon.ca", "amazon-ca", "Amazon CA"), ("mcmaster.com", "mcmaster", "McMaster-Carr"), ("boltdepot.com", "boltdepot", "Bolt Depot"),
    ("misumi.eu", "misumi", "Misumi"), ("misumi-ec.com", "misumi", "Misumi"), ("us.misumi-ec.com", "misumi", "Misumi"), ("robotdigg.com", "robotdigg", "RobotDigg"),
    ("filastruder.com", "filastruder", "Filastruder"), ("e3d-online.com", "e3d", "E3D"), ("bondtech.se", "bondtech", "Bondtech"),
    ("trianglelab.net", "trianglelab", "Trianglelab"), ("digikey.com", "digikey", "Digi-Key"), ("mouser.com", "mouser", "Mouser"), ("sdp-si.com", "sdp-si", "SDP/SI"),
    ("shop.sdp-si.com", "sdp-si", "SDP/SI"), ("omc-stepperonline.com", "stepperonline", "StepperOnline"), ("zyltech.com", "zyltech", "Zyltech"),
    ("west3d.com", "west3d", "West3D"), ("kb-3d.com", "kb3d", "KB-3D"), ("fabreeko.com", "fabreeko", "Fabreeko"), ("printedsolid.com", "printedsolid", "Printed Solid"),
    ("matterhackers.com", "matterhackers", "MatterHackers"), ("paramount-3d.com", "paramount3d", "Paramount 3D"), ("ldomotors.com", "ldo", "LDO Motors"),
    ("meanwell.com", "meanwell", "Mean Well"), ("digitmakers.ca", "digitmakers", "Digitmakers"), ("3dprintingcanada.com", "3dpc", "3D Printing Canada"),
    ("keenovo.com", "keenovo", "Keenovo"), ("duet3d.com", "duet3d", "Duet3D"), ("pif.voron.dev", "pif", "Print It Forward"), ("voron.dev", "voron", "Voron Design"),
    ("grainger.com", "grainger", "Grainger"), ("zoro.com", "zoro", "Zoro"), ("ebay.com", "ebay", "eBay"), ("banggood.com", "banggood", "Banggood"),
    ("hobbytown.com", "hobbytown", "HobbyTown"), ("wago.com", "wago", "Wago"), ("biqu.equipment", "biqu", "BIQU"), ("bigtree-tech.com", "btt", "BIGTREETECH"),
    ("mellow3d.com", "mellow", "Mellow"), ("fysetc.com", "fysetc", "FYSETC"), ("formbot3d.com", "formbot", "Formbot"), ("siboor.com", "siboor", "Siboor"),
    ("taobao.com", "taobao", "Taobao"), ("tmall.com", "taobao", "Tmall"),
]
# ---- fixed values: affiliate hosts and query keys
AFFILIATE_HOSTS = ["s.click.aliexpress.com", "amzn.to"]
AFFILIATE_KEYS = ["tag", "aff_platform", "aff_trace_key", "aff_fcid", "af", "aff_fsk", "aff_short_key", "linkcode", "ascsubtag"]
# ---- fixed values: query keys that say nothing about the product
TRACKING_KEYS = [
    "spm", "pvid", "gps-id", "scm", "scm-url", "scm_id", "scm-id", "ad_pvid", "algo_pvid", "algo_expid", "btsid", "ws_ab_test", "curpagelogauid", "curpagelogid",
    "_randl_currency", "_randl_shipto", "srcsns", "businesstype", "templateid", "pageid", "netw", "terminal_id", "afref", "sk", "s", "aem_p4p_detail", "pdp_npi",
    "utparam", "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid", "mc_cid", "mc_eid", "psc", "keywords", "qid", "sr", "th",
    "ref", "ref_", "dchild", "smid", "pd_rd_i", "pd_rd_r", "pd_rd_w", "pd_rd_wg", "pf_rd_p", "pf_rd_r", "linkid", "crid", "sprefix", "ie",
]
# ---- fixed values: wording of pages
WALL_TEXT = [
    "enter the characters you see below", "to discuss automated access to amazon data", "are you a robot", "unusual traffic", "captcha", "access denied",
    r"just a moment\.\.\.", "please (sign|log) in", "sign in to continue", "security check", "verify you are a human",
]
AMAZON_DEAD = ["we couldn'?t find that page", "dogs of amazon", "the web address you entered is not a functioning page"]
DEAD_TITLE = r"<title>[^<]{0,80}\b(404|page not found|not found)\b[^<]{0,80}</title>"
DEAD_TEXT = [r"\bthis (product|item|listing) (has been|was) removed\b", r"\bproduct (is )?no longer available\b"]
PARKED_HOSTS = [
    "sedoparking.com", "sedo.com", "dan.com", "undeveloped.com", "afternic.com", "hugedomains.com", "bodis.com", "parkingcrew.net", "above.com", "buydomains.com",
    "domainmarket.com", "squadhelp.com", "atom.com", "namecheap.com",
]
PARKED_TEXT = [
    r"\bthis domain (name )?is for sale\b", r"\bbuy this domain\b", r"\bthe domain .{0,40} is for sale\b", r"\bdomain (name )?for sale\b", r"\binquire about this domain\b",
    r"\bthe owner of this domain\b.{0,60}\bsell\b", r"\bthis (web )?page is parked\b", r"\bparked (free )?(courtesy of|by)\b",
]
CHALLENGE_URL = r"_____tmd_____|/punish|x5secdata|/cdn-cgi/challenge"
BLOCKED_HOSTS = ["mcmaster.com", "misumi-ec.com", "us.misumi-ec.com"]
SKIP_HOSTS = ["cnckitchenus.store", "tapplastics.com", "harborfreight.com"]
# ---- fixed values: coverage buckets in report order
BUCKETS = ["none_live", "no_links", "partial", "unknown", "all_live"]
# ---- fixed values: hosts that are asked half as often
SLOW_HOSTS = ["aliexpress.com", "s.click.aliexpress.com", "amazon.com", "amzn.to"]
