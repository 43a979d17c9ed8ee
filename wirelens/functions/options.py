"""Names of DHCP options."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wirelens.functions.names import named

# Option names, as decoded events show them; other options have none.
DHCPV4_OPTIONS = {
    0: "Pad", 1: "Subnet Mask", 2: "Time Offset", 3: "Router", 4: "Time Server", 5: "Name Server", 6: "Domain Server",
    7: "Log Server", 8: "Quotes Server", 9: "LPR Server", 10: "Impress Server", 11: "RLP Server", 12: "Hostname",
    13: "Boot File Size", 14: "Merit Dump File", 15: "Domain Name", 16: "Swap Server", 17: "Root Path",
    18: "Extension File", 19: "Forward On/Off", 20: "SrcRte On/Off", 21: "Policy Filter", 22: "Max DG Assembly",
    23: "Default IP TTL", 24: "MTU Timeout", 25: "MTU Plateau", 26: "MTU Interface", 27: "MTU Subnet",
    28: "Broadcast Address", 29: "Mask Discovery", 30: "Mask Supplier", 31: "Router Discovery", 32: "Router Request",
    33: "Static Route", 34: "Trailers", 35: "ARP Timeout", 36: "Ethernet", 37: "Default TCP TTL",
    38: "Keepalive Time", 39: "Keepalive Data", 40: "NIS Domain", 41: "NIS Servers", 42: "NTP Servers",
    43: "Vendor Specific Information", 44: "NETBIOS Name Srv", 45: "NETBIOS Dist Srv", 46: "NETBIOS Node Type",
    47: "NETBIOS Scope", 48: "X Window Font", 49: "X Window Manager", 50: "Requested IP Address",
    51: "IP Address Lease Time", 52: "Overload", 53: "DHCP Message Type", 54: "DHCP Server Identifier",
    55: "Parameter Request List", 56: "Message", 57: "DHCP Max Message Size", 58: "Renewal Time Value",
    59: "Rebinding Time Value", 60: "Class Identifier", 61: "Client Identifier", 64: "NIS+ Domain", 65: "NIS+ Server",
    66: "TFTP Server Name", 67: "Bootfile Name", 68: "Mobile IP Home Agent", 69: "SMTP Server", 70: "POP3 Server",
    71: "NNTP Server", 72: "WWW Server", 73: "Finger Server", 74: "IRC Server", 75: "StreetTalk Server",
    76: "STDA Server", 77: "User Class", 78: "Directory Agent", 79: "Service Scope", 80: "Rapid Commit",
    81: "FQDN, Fully Qualified Domain Name", 82: "Relay Agent Information", 83: "iSNS", 85: "NDS Servers",
    86: "NDS Tree Name", 87: "NDS Context", 88: "BCMCS Controller Domain Name list",
    89: "BCMCS Controller IPv4 address list", 90: "Authentication", 91: "client-last-transaction-time",
    92: "associated-ip", 93: "Client System Architecture Type", 94: "Client Network Interface Identifier", 95: "LDAP",
    97: "UUID/GUID-based Client Identifier", 98: "User-Auth", 99: "GEOCONF_CIVIC", 100: "PCode", 101: "TCode",
    112: "Netinfo Address", 113: "Netinfo Tag", 114: "URL", 116: "Auto Config", 117: "Name Service Search",
    118: "Subnet Selection Option", 119: "Domain Search", 120: "SIP Servers DHCP Option",
    121: "Classless Static Route", 122: "CCC, CableLabs Client Configuration", 123: "GeoConf",
    124: "V-I Vendor Class", 125: "V-I Vendor-Specific Information", 136: "PANA Agent", 137: "V4 Lost",
    138: "CAPWAP Access Controller addresses", 141: "SIP UA Configuration Service Domains",
    145: "Forcerenew Nonce Capable", 146: "RDNSS Selection", 150: "TFTP Server Address", 159: "V4 Portparams",
    175: "Etherboot (Tentatively Assigned)", 208: "PXELINUX Magic (deprecated)", 209: "Configuration File",
    210: "Path Prefix", 211: "Reboot Time", 212: "OPTION_6RD", 213: "OPTION_V4_ACCESS_DOMAIN",
    220: "Subnet Allocation Option", 221: "Virtual Subnet Selection", 249: "Microsoft Classless Static Route",
    252: "Proxy autodiscovery (WPAD)", 255: "End",
}
DHCPV6_OPTIONS = {
    1: "OPTION_CLIENTID", 2: "OPTION_SERVERID", 3: "OPTION_IA_NA", 4: "OPTION_IA_TA", 5: "OPTION_IAADDR",
    6: "OPTION_ORO", 7: "OPTION_PREFERENCE", 8: "OPTION_ELAPSED_TIME", 9: "OPTION_RELAY_MSG", 11: "OPTION_AUTH",
    12: "OPTION_UNICAST", 13: "OPTION_STATUS_CODE", 14: "OPTION_RAPID_COMMIT", 15: "OPTION_USER_CLASS",
    16: "OPTION_VENDOR_CLASS", 17: "OPTION_VENDOR_OPTS", 18: "OPTION_INTERFACE_ID", 19: "OPTION_RECONF_MSG",
    20: "OPTION_RECONF_ACCEPT", 21: "OPTION_SIP_SERVER_D", 22: "OPTION_SIP_SERVER_A", 23: "OPTION_DNS_SERVERS",
    24: "OPTION_DOMAIN_LIST", 25: "OPTION_IA_PD", 26: "OPTION_IAPREFIX", 27: "OPTION_NIS_SERVERS",
    28: "OPTION_NISP_SERVERS", 29: "OPTION_NIS_DOMAIN_NAME", 30: "OPTION_NISP_DOMAIN_NAME", 31: "OPTION_SNTP_SERVERS",
    32: "OPTION_INFORMATION_REFRESH_TIME", 33: "OPTION_BCMCS_SERVER_D", 34: "OPTION_BCMCS_SERVER_A",
    36: "OPTION_GEOCONF_CIVIC", 37: "OPTION_REMOTE_ID", 38: "OPTION_SUBSCRIBER_ID", 39: "OPTION_CLIENT_FQDN",
    40: "OPTION_PANA_AGENT", 41: "OPTION_NEW_POSIX_TIMEZONE", 42: "OPTION_NEW_TZDB_TIMEZONE", 43: "OPTION_ERO",
    44: "OPTION_LQ_QUERY", 45: "OPTION_CLIENT_DATA", 46: "OPTION_CLT_TIME", 47: "OPTION_LQ_RELAY_DATA",
    48: "OPTION_LQ_CLIENT_LINK", 49: "OPTION_MIP6_HNIDF", 50: "OPTION_MIP6_VDINF", 51: "OPTION_V6_LOST",
    52: "OPTION_CAPWAP_AC_V6", 53: "OPTION_RELAY_ID", 54: "OPTION-IPv6_Address-MoS", 55: "OPTION-IPv6_FQDN-MoS",
    56: "OPTION_NTP_SERVER", 57: "OPTION_V6_ACCESS_DOMAIN", 58: "OPTION_SIP_UA_CS_LIST", 59: "OPT_BOOTFILE_URL",
    60: "OPT_BOOTFILE_PARAM", 61: "OPTION_CLIENT_ARCH_TYPE", 62: "OPTION_NII", 63: "OPTION_GEOLOCATION",
    64: "OPTION_AFTR_NAME", 65: "OPTION_ERP_LOCAL_DOMAIN_NAME", 66: "OPTION_DS_LITE_ADDRESS_ALTERNATE",
    67: "OPTION_PD_EXCLUDE", 68: "OPTION_VSS", 69: "OPTION_MIP6_IDINF", 70: "OPTION_MIP6_UDINF",
    71: "OPTION_MIP6_HNP", 72: "OPTION_MIP6_HAA", 73: "OPTION_MIP6_HAF", 74: "OPTION_RDNSS_SELECTION",
    79: "OPTION_CLIENT_LINKLAYER_ADDR", 80: "OPTION_LINK_ADDRESS", 81: "OPTION_RADIUS", 82: "OPTION_SOL_MAX_RT",
    83: "OPTION_INF_MAX_RT", 84: "OPTION_ADDRSEL", 85: "OPTION_ADDRSEL_TABLE", 86: "OPTION_V6_PCP_SERVER",
    87: "OPTION_DHCPV4_MSG", 88: "OPTION_DHCP4_O_DHCP6_SERVER", 89: "OPTION_S46_RULE", 90: "OPTION_S46_BR",
    91: "OPTION_S46_DMR", 92: "OPTION_S46_V4V6BIND", 93: "OPTION_S46_PORTPARAMS", 94: "OPTION_S46_CONT_MAPE",
    95: "OPTION_S46_CONT_MAPT", 96: "OPTION_S46_CONT_LW", 97: "OPTION_4RD", 98: "OPTION_4RD_MAP_RULE",
    99: "OPTION_4RD_NON_MAP_RULE", 100: "OPTION_LQ_BASE_TIME", 101: "OPTION_LQ_START_TIME", 102: "OPTION_LQ_END_TIME",
    103: "OPTION_DHCP_STATE", 104: "OPTION_DATA_SOURCE", 143: "OPTION_IPV6_ADDRESS_ANDSF",
}


def dhcpv4_option_name(code: Column) -> Column:
    return F.coalesce(named(code, DHCPV4_OPTIONS), F.lit(""))


def dhcpv6_option_name(code: Column) -> Column:
    return F.coalesce(named(code, DHCPV6_OPTIONS), F.lit(""))
