"""Configuration: rule lists, rename maps, label maps and network parameters.

The blocks marked FIXED VALUES must equal the behaviour being reproduced (patterns, key
names, lookup tables); everything else is a parameter with a default.  Allow-lists, device
lists and address ranges are parameters only -- no real addresses live in this module.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------------------
# FIXED VALUES -- firewall vendor classification.  Ordered; the first rule that matches
# the start of the trimmed message decides the vendor.  Patterns are kept in their
# original (Python named-group) spelling; ``functions.text.java_regex`` adapts them.
# ---------------------------------------------------------------------------------------
VENDOR_RULES: list[tuple[str, str, str]] = [
    # (vendor, fire_type, pattern)
    ("zhenguan", "4",
     r"(?P<date1>\w+\ +\d+ \d{2}:\d{2}:\d{2}) (?P<host>[a-zA-Z0-9_\-]+) (?P<type>APP_POLICY): (?P<message>.*)"),
    ("hillstone", "2",
     r"(?P<time>\w+\ +\d+ \d{2}:\d{2}:\d{2} \d+\(.*\) \w+) (EMERG|ALERT|CRIT|ERR|Event|Threat|Traffic)@.*: (?P<type>\w+): (?P<message>.*)"),
    ("star", "1",
     r"(?P<date1>\w+\ +\d+ \d{2}:\d{2}:\d{2}) (?P<host>[a-zA-Z0-9_\-]+) (?P<type>FILTER|IPS|AV): (?P<message>.*)"),
    ("gap", "3",
     r"charset=\[[a-zA-Z0-9_\-]+\]\ +logType=\[(?P<type>\w+)\]\ +(?P<message>.*)"),
]

# FIXED VALUES -- per-vendor detail rules, ordered, first match wins.
VENDOR_DETAIL_RULES: dict[str, list[str]] = {
    "zhenguan": [
        r'(?P<message1>.*) GenTime="(?P<GenTime>\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})" (?P<message2>.*) Content="(?P<Content>.*)"',
        r'(?P<message1>.*) GenTime="(?P<GenTime>\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})" (?P<message2>.*)',
    ],
    "star": [
        r'(?P<message1>.*) GenTime="(?P<GenTime>\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})" NatType="(?P<NatType>.*)" (?P<message2>.*) Content="(?P<Content>.*)"',
        r'(?P<message1>.*) GenTime="(?P<GenTime>\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})" (?P<message2>.*) Content="(?P<Content>.*)"',
    ],
    "hillstone": [
        r".* from (?P<SrcIP>.*):(?P<SrcPort>\d{1,5}) to (?P<DstIP>.*):(?P<DstPort>\d{1,5})",
        r"(?P<SrcIP>.*):(?P<SrcPort>\d{1,5})->(?P<DstIP>.*):(?P<DstPort>\d{1,5})\((?P<Protocol>.*)\), snat to (?P<AfterTransAddr>.*):(?P<AfterTransPort>\d{2,5})",
    ],
    "gap": [
        r"pass",
    ],
}

# FIXED VALUES -- log types the "star" vendor keeps; other types are dropped after counting.
STAR_KEPT_TYPES: list[str] = ["AV", "IPS"]
# FIXED VALUES -- named fields each k=v vendor keeps from its detail regex besides the tokens.
KV_VENDOR_CAPTURES: dict[str, list[str]] = {
    "star": ["GenTime", "Content", "NatType"],
    "zhenguan": [],
}

# FIXED VALUES -- rename map shared by vendors with fire_type 1 and 2.
RENAME_MAP_12: dict[str, str] = {
    "SrcIP": "sip", "DstIP": "dip", "Protocol": "pro", "SrcPort": "sport", "DstPort": "dport",
    "InInterface": "iface", "OutInterface": "oface", "SMAC": "smac", "DMAC": "dmac", "App": "app",
    "Action": "action", "AppAction": "appaction", "Url": "url", "PolicyID": "policyid",
    "PolicyName": "policyname", "EndTime": "etime", "NatType": "nattype",
    "BeforeTransAddr": "beforetaddr", "AfterTransAddr": "aftertaddr",
    "BeforeTransPort": "beforetport", "AfterTransPort": "aftertport", "Content": "content",
    "InterfaceName": "facename", "InterfaceAddr": "faceaddr", "EventHappen": "eventname",
    "OldState": "oldstate", "NewState": "newstate", "PacketType": "packettype",
    "NBRRouterID": "nbrrid", "ManageStyle": "mstyle", "Operate": "operate",
    "UserName": "username", "GenTime": "gentime", "SerialNum": "serialnum", "RuleID": "ruleid",
    "EventID": "eventid", "EventSet": "eventset", "EventName": "eventname",
    "EventType": "eventtype", "EvtCount": "evtcount", "VirusName": "virusname",
    "VirusFileName": "virusfilename", "AAA": "aaa",
}
# FIXED VALUES -- rename map for fire_type 4.
RENAME_MAP_4: dict[str, str] = {
    "SrcIP": "sip", "DstIP": "dip", "ProtocolType": "pro", "SrcPort": "sport", "DstPort": "dport",
    "InInterface": "iface", "OutInterface": "oface", "SrcMac": "smac", "DstMac": "dmac",
    "AppName": "app", "Action": "action", "AppAction": "appaction", "Url": "url",
    "PolicyId": "policyid", "PolicyName": "policyname", "EndTime": "etime", "NatType": "nattype",
    "BeforeTransAddr": "beforetaddr", "AfterTransAddr": "aftertaddr",
    "BeforeTransPort": "beforetport", "AfterTransPort": "aftertport", "Content": "content",
    "InterfaceName": "facename", "InterfaceAddr": "faceaddr", "EventHappen": "eventname",
    "OldState": "oldstate", "NewState": "newstate", "PacketType": "packettype",
    "NBRRouterID": "nbrrid", "ManageStyle": "mstyle", "Operate": "operate",
    "UserName": "username", "GenTime": "gentime", "SerialNum": "serialnum", "RuleID": "ruleid",
    "EventID": "eventid", "EventSet": "eventset", "EventName": "eventname",
    "EventType": "eventtype", "EvtCount": "evtcount", "VirusName": "virusname",
    "VirusFileName": "virusfilename", "UserID": "aaa",
}
RENAME_MAPS: dict[str, dict[str, str]] = {"1": RENAME_MAP_12, "2": RENAME_MAP_12, "4": RENAME_MAP_4}

# ---------------------------------------------------------------------------------------
# FIXED VALUES -- malware category / behaviour / rule-class label map (115 keys).
# ---------------------------------------------------------------------------------------
LABEL_MAP: dict[str, str] = {
    "adtool": "广告工具", "adware": "广告软件", "arcbomb": "包裹炸弹", "avtool": "反病毒工具",
    "backdoor": "后门", "badjoke": "恶意玩笑程序", "banker": "银行木马", "clicker": "点击器（刷数据）",
    "client-irc": "IRC客户端", "client-p2p": "P2P客户端", "client-smtp": "SMTP客户端",
    "constructor": "病毒生成器", "cracktool": "破解工具", "ddos": "分布式拒绝服务攻击",
    "dialer": "拨号程序", "dos": "拒绝服务攻击", "downloader": "下载者", "dropper": "捆绑者",
    "email": "通过Email传播", "exploit": "溢出代码", "fakeav": "伪杀毒软件", "flooder": "洪水攻击",
    "fraudtool": "恶意欺骗工具", "gamethief": "盗窃游戏账号", "garbage": "垃圾文件",
    "hacktool": "黑客工具", "hoax": "恶作剧程序", "im": "通过即时通讯传播", "irc": "通过IRC传播",
    "joke": "玩笑程序", "mailfinder": "搜集邮件", "monitor": "监控程序", "multipacked": "多重加壳",
    "net": "通过网络传播", "nettool": "网络工具", "notifier": "通知程序", "p2p": "通过P2P传播",
    "packed": "包裹（壳）", "porn-dialer": "色情软件", "porn-downloader": "色情下载程序",
    "porn-tool": "色情工具", "proxy": "代理程序", "psw": "窃取密码", "pswtool": "窃取密码工具",
    "ransom": "勒索软件", "remoteadmin": "远程管理软件", "risktool": "风险工具", "rootkit": "隐匿程式",
    "server-ftp": "FTP服务端", "server-proxy": "代理服务端", "server-telnet": "Telnet服务端",
    "server-web": "Web服务端", "sms": "短信木马", "spamtool": "垃圾邮件工具", "spoof": "欺骗工具",
    "spy": "窃取行为", "suspiciouspacker": "可疑包（壳）", "tool": "攻击工具", "virtool": "病毒工具",
    "webtoolbar": "浏览器工具条", "modifier": "浏览器修改", "autorun": "自动运行",
    "injector": "注射式攻击", "phishing": "网络仿冒", "toolbar": "篡改工具栏", "keylogger": "键盘记录器",
    "filecoder": "文件加密", "addisplay": "插播广告", "lockscreen": "锁定屏幕", "spammer": "发送垃圾邮件",
    "hllw": "伴生文件", "sniffer": "嗅探器", "bundler": "打包器", "rogue": "流氓软件",
    "riskware": "风险软件", "trojan": "木马程序", "testfile": "测试文件", "junkfile": "垃圾文件",
    "vcs": "启发式病毒", "grayware": "灰色软件", "spyware": "风险软件", "virus": "感染式病毒",
    "worm": "蠕虫程序",
    "attempted-admin": "尝试获取管理员权限", "attempted-user": "尝试获取用户权限",
    "default-login-attempt": "尝试以默认用户名和密码登录", "successful-admin": "成功获取管理员权限",
    "successful-user": "成功获取用户权限", "unsuccessful-user": "获取用户权限失败",
    "suspicious-login": "可疑登录", "network-scan": "网络扫描", "attempted-recon": "尝试侦察探测",
    "successful-recon-largescale": "大规模侦察探测成功", "successful-recon-limited": "侦察探测成功",
    "attempted-dos": "尝试造成拒绝服务", "denial-of-service": "拒绝服务攻击",
    "successful-dos": "成功造成拒绝服务", "web-application-activity": "Web应用活动",
    "web-application-attack": "Web应用攻击", "misc-activity": "其他活动", "trojan-activity": "C2通信",
    "shellcode-detect": "缓冲区溢出尝试", "unusual-client-port-connection": "非常见端口使用",
    "non-standard-protocol": "非标准协议", "policy-violation": "疑似违规",
    "protocol-command-decode": "通用协议命令", "icmp-event": "通用ICMP事件", "tcp-connection": "TCP连接",
    "string-detect": "可疑字符串", "suspicious-filename-detect": "可疑文件名", "bad-unknown": "潜在恶意流量",
    "inappropriate-content": "不当内容", "not-suspicious": "非可疑流量",
    "rpc-portmap-decode": "远程调用解码", "system-call-detect": "系统调用",
}

# FIXED VALUES -- ATT&CK tactic numbers, English names (sensor) and local names (endpoint).
TACTIC_NUMBER_EN: dict[str, str] = {
    "Initial Access": "1", "Execution": "2", "Persistence": "3", "Privilege Escalation": "4",
    "Defense Evasion": "5", "Credential Access": "6", "Discovery": "7", "Lateral Movement": "8",
    "Collection": "9", "Command and Control": "10", "Command And Control": "10",
    "Exfiltration": "11", "Impact": "12",
}
TACTIC_NUMBER_LOCAL: dict[str, str] = {
    "初始访问": "1", "执行": "2", "持久化": "3", "提权": "4", "防御规避": "5", "凭证访问": "6",
    "发现": "7", "横向运动": "8", "收集": "9", "命令控制": "10", "渗透": "11", "影响": "12",
}
# FIXED VALUES -- kill-chain stage numbers; "Presence" is looked up by its objective.
STAGE_NUMBER_EN: dict[str, str] = {
    "Administer": "1", "Engagement": "2", "Installation|Execution": "3",
    "Installation & Execution": "3", "Installation": "3", "Execution": "3",
    "Privilege Escalation": "3", "Credential Access": "4", "Lateral Movement": "4",
    "Persistence": "4", "Effect": "5", "Ongoing Processes": "6",
}
STAGE_NUMBER_LOCAL: dict[str, str] = {
    "准备": "2", "交互": "3", "存在": "4", "影响": "5", "持续": "6", "管理": "1",
}
# FIXED VALUES -- detect object by legacy endpoint event type.
DETECT_OBJECT_BY_TYPE: dict[str, str] = {
    "proc_protect": "目的载荷", "active_protect": "目的载体",
    "virus_detect": "源载荷", "virus_defend": "目的载荷",
}
DETECT_OBJECT_SOURCE_LOAD = "源载荷"

# FIXED VALUES -- threat type action keywords and event-type names (sensor classification).
ACTION_C2 = "利用僵尸网络"
ACTION_WEB_IMPLANT = "网站植入"
ACTION_INFECTED_HOST = "利用受感染主机"
ACTION_MALICIOUS_MAIL = "发送恶意邮件"
ACTION_REMOTE_SHARE_WRITE = "写入远程文件共享"
ACTION_LEGIT_REMOTE_ACCESS = "利用合法远程访问"
ACTION_TAINT_SHARED = "污染共享内容"
ACTION_CHAT = "使用聊天服务"
ACTION_FIRMWARE_VULN = "利用固件漏洞"
ACTION_DB_INJECTION = "注入数据库命令"
ACTION_REMOTE_APP_VULN = "利用远程应用程序漏洞"
VENDOR_FIRMWARE_WORDS: list[str] = ["Cicso", "Huawei", "思科", "华为"]
MAIL_PROTOCOLS: list[str] = ["SMTP", "IMAP", "POP", "POP3"]
EVENT_NAMES: dict[str, tuple[str, str]] = {
    "c2": ("网络攻击事件", "C2通信"),
    "vul": ("网络攻击事件", "漏洞攻击事件"),
    "md5": ("有害程序", ""),
}

# FIXED VALUES -- SNMP storage type OIDs (hrStorageTypes) and their names.
STORAGE_TYPES: dict[str, str] = {
    "1.3.6.1.2.1.25.2.1.3": "hrStorageVirtualMemory",
    "1.3.6.1.2.1.25.2.1.2": "hrStorageRam",
    "1.3.6.1.2.1.25.2.1.4": "hrStorgeFixedDisk",
    "1.3.6.1.2.1.25.2.1.5": "hrStorageRemovableDisk",
    "1.3.6.1.2.1.25.2.1.6": "hrStorageFloppyDisk",
    "1.3.6.1.2.1.25.2.1.7": "hrStorageCompactDisc",
    "1.3.6.1.2.1.25.2.1.8": "hrStorageRamDisk",
    "1.3.6.1.2.1.25.2.1.9": "hrStorageFlashMemory",
    "1.3.6.1.2.1.25.2.1.10": "hrStorageNetworkDisk",
}
STORAGE_TYPE_OTHER = "hrStorageOther"
# FIXED VALUES -- trap OID carrying the trap type (snmpTrapOID.0).
SNMP_TRAP_OID = "1.3.6.1.6.3.1.1.4.1.0"

# FIXED VALUES -- plain syslog line (time, host, owner, [pid], [level], [other], msg) and the
# level -> severity table; an owner of "ecms_troubleshoot" is always an emergency.
SYSLOG_LINE_PATTERN = (r"(?P<time>\w+ ( )?\d+ \d{2}:\d{2}:\d{2}) (?P<host>\w+) (?P<owner>\w+):( +)?"
                       r"(?P<pid>(\[\d+\])?)(?P<level>(\[\w+\])?) ?(?P<other>(\[\w+\])?) ?(?P<msg>(.*))")
SYSLOG_LEVEL_SEVERITY: dict[str, int] = {"INFO": 6, "WARN": 4, "ERROR": 3, "DEBUG": 7}
SYSLOG_DEFAULT_SEVERITY = 6
SYSLOG_EMERGENCY_OWNERS: list[str] = ["ecms_troubleshoot"]
SYSLOG_USER_FACILITY = 1

# FIXED VALUES -- private IPv4 blocks (first address, prefix length).
PRIVATE_BLOCKS: list[tuple[str, int]] = [
    ("127.0.0.0", 8), ("192.168.0.0", 16), ("172.16.0.0", 12), ("10.0.0.0", 8),
]

# FIXED VALUES -- presence windows in minutes (data, heartbeat) and defaults.
PRESENCE_DATA_MINUTES = 240
PRESENCE_HEARTBEAT_MINUTES = 120
DEFAULT_NODE_ID = "1"

# FIXED VALUES -- asset source codes.
SOURCE_ENDPOINT, SOURCE_MANUAL, SOURCE_SENSOR, SOURCE_CMDB, SOURCE_FIREWALL = "0", "1", "2", "3", "4"


@dataclass(frozen=True)
class EngineParams:
    """Deployment parameters (never hard-coded addresses)."""

    sensor_allow_list: tuple[str, ...] = ("-1",)          # "-1" = every sensor
    endpoint_server_allow_list: tuple[str, ...] = ("-1",)  # "-1" = every server
    company_external_lo: str = "198.51.100.0"              # inclusive company-owned range
    company_external_hi: str = "198.51.100.255"
    presence_data_minutes: int = PRESENCE_DATA_MINUTES
    presence_heartbeat_minutes: int = PRESENCE_HEARTBEAT_MINUTES
    retry_max_attempts: int = 3
    device_names: dict[str, str] = field(default_factory=dict)


DEFAULT_PARAMS = EngineParams()
