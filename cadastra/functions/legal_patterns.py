"""The wording found in legal descriptions.

Order matters everywhere: a match is cut out before the next pattern is tried.
"""

# Marks put before wording that only looks like a parcel: (words it holds, pattern, replacement).
MARK = "$$$$ "
MARK_BEFORE = [
    (" (", r" \(", r" \$\$\$\$ ("),
    (" HCP", r" HCP([\w+/]+)", r" \$\$\$\$ HCP$1"),
    (" PM", r" PM([\w+/]+)", r" \$\$\$\$ PM$1"),
    ("PTARC/", r"(PTARC)/(\w+)", r" \$\$\$\$ $1/$2"),
    ("PTARC", r"(PTARC)(\w+)", r" \$\$\$\$ $1 $2"),
]

# Labelled ids: (kind, pattern); group 1 is the id.
LABELLED_IDS = [
    ("wind_farm", r"Wind Farm\s+(\w+)"),
    ("consolidated_mining_lease", r"Consolidated Mining Lease\s+(\w+)"),
    ("public_reserve", r"Public Reserve\s+(\w+)"),
    ("perpetual_lease", r"Perpetual Lease\s+([\w/]+)"),
    ("mining_lease", r"Mining Permit\s+(\w+)"),
    ("telstra_site", r"Telstra Site Number\s+(\w+)"),
    ("mineral_claim", r"Mineral Claim\s+(\w+)"),
    ("western_land_lease", r"Western Land Lease\s+(\w+)"),
    ("railway_land_lease", r"Railway Land Lease\s+(\d+(?:\.\d+)?(?:/[\w/]+)?)"),
    ("stock_watering_place", r"Stock Watering Place\s+(\w+)"),
    ("special_lease", r"Special Lease\s+([\w/]+)"),
    ("forest_permit", r"Forest Permit\s+(\w+)"),
    ("enclosure_permit", r"Enclosure Permit\s+([\w/]+)"),
    ("non_irrigable_purchase", r"Non-Irrigable Purchase\s+(\w+)"),
    ("nsw_maritime", r"NSW Maritime\s+([\w/]+)"),
    ("housing_prn", r"Housing PRN\s+([\w/]+)"),
    ("crown_roads_licence", r"crown roads Licence\s+(\d+)"),
    ("crown_land_licence", r"Licence\s+(\d+)"),
    ("bus_depot_lease", r"BUS DEPOT LEASE\s+(\w+)"),
    ("state_heritage", r"(?i)State Heritage Listing No\s+(\w+)"),
    ("permissive_occupancy", r"Permissive Occupancy\s+([\w/]+)"),
    ("railcorp_file", r"(?i)RAILCORP\. FILE:\s+(\w+)"),
    ("domestic_waterfront", r"Domestic Waterfront Occupancy\s+(\w+)"),
    ("occupancy_permit", r"Occupation Permit PB\s+([\w/]+)"),
    ("occupancy_permit", r"Occupation Permit\s+([\w/]+)"),
    ("occupancy_permit", r"Occupancy Permit\s+([\w/]+)"),
]

# Named groups: (kind, pattern, group of the id, group of the second id, part).
# part is a group number, True (always partial) or None (no such flag).
NAMED_GROUPS = [
    ("state_heritage", r"(?i)State Heritage\s+(?:Register|REGISTRAR)\s+(?:SHR\s+NO\.\s+)?(\w+)", 1, None, None),
    ("state_heritage", r"(?i)Subject to (?:SHR|SHRL) No\s+(\w+)", 1, None, None),
    ("crown_reserve", r"Crown Reserve\s+(\w+)", 1, None, None),
    ("crown_plan", r"Part Crown Plan\s+(\w+)-(\w+)", 1, 2, True),
    ("crown_plan", r"Crown Plan\s+(\w+)-(\w+)(\s+\(Part\))?", 1, 2, 3),
    ("mining_lease", r"(?i)Mining (?:Purpose )?Lease\s+(\w+)(\s+\(Part\))?", 1, None, 2),
    ("consolidated_coal_lease", r"(?i)Consolidated Coal Lease\s+(\w+)(\s+\(Part\))?", 1, None, 2),
    ("coal_lease", r"(?i)Coal Lease\s+(\w+)(\s+\(Part\))?", 1, None, 2),
    ("mineral_lease", r"(?i)Mineral Lease\s+(\w+)(\s+\(Part\))?", 1, None, 2),
    ("lease_number", r"Lease Number\s+([\w/]+) TO ([\w/]+)", 1, 2, None),
    ("lease_number", r"Lease Number\s+([\w/]+)(?: - ([\w/]+))?", 1, 2, None),
    ("sydney_ports_plan", r"Site\s+(\w+) of Sydney Ports Corporation Plan\s+(\w+)", 1, 2, None),
]

FLAGS = [("drainage_reserve", r"DRAINAGE RESERVE")]

# Wording without information, cut out before and after the patterns above.
IGNORE_BEFORE = [
    r"Licence for grazing",
    r"(?i)NSW Maritime Lease of \w+ sqm('s)?",
]
IGNORE_AFTER = [
    r"(?i)(TOTAL )?SU(B)?SURFACE\s+(AREA\s+)?(=|-)?\s+(\w+)(\.\w+)?(\s+)?HA",
    r"UNDEFINED ROAD RESERVE",
    r"(?i)& road reserve",
    r"Crown Road",
    r"(?i)THE WANGANELLA WILDLIFE REFUGE NO \w+",
    r"(?i)COONONG WILDLIFE REFUGE (NO )?\w+",
    r"(?i)(Partly )?(Un)?Lim(it|ti)ed in height (and|but|\&) ((Un)?lim(it|ti)ed in )?depth",
    r"(?i)(Partly )?(Un)?Lim(it|ti)ed in depth (and|but|\&) ((Un)?lim(it|ti)ed in )?height",
    r"(?i)(Partly )?(Un)?Lim(it|ti)ed in (depth|height)",
    r"(?i)LEASE ATTACHED TO PROPERTY",
    r"(?i)Limited in Stratum",
    r"(?i)(lease|least) (OVER|OVE) property",
    r"(?i)PROPERTY (OVER|OVE) LEASE",
    r"(?i)SUBSURFACE ONLY",
    r"(?i)LOT \w+ DP \w+ MINERAL ONLY",
    r"(?i)COAL ONLY PLAN - \w+",
    r"(?i)Share Use",
    r"(?i)Shared Use",
    r"(?i)EXCLUDING SURFACE LAND VALUED ON OCCUPATION",
    r"(Unleased )?floor space area",
]

# Parcel parts: longest lot, section and plan.
MAX_LOT, MAX_SECTION, MAX_PLAN = 5, 4, 9
