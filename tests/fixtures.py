"""Small CMS-shaped CSV files with the edge rows the jobs must handle."""

from __future__ import annotations

import csv
import os

MASTER_HEADER = [
    "PROVNUM", "PROVNAME", "STATE", "WorkDate", "Hrs_RNDON", "Hrs_RN", "Hrs_LPN",
    "Hrs_CNA", "Hrs_Rnadmin", "Hrs_LPNadmin", "MDScensus",
]
MASTER_ROWS = [
    # leading zeros, padded lower-case state
    [" 015009 ", "Alpha Home", " al ", "2024-04-01", "8", "10", "5", "20", "2", "1", "50"],
    # duplicate (PROVNUM, WorkDate): the survivor is the first in order
    ["015009", "Alpha Home", "AL", "2024-04-01", "9", "12", "6", "21", "", "", "50"],
    ["015009", "Alpha Home", "AL", "2024-04-02", "7", "", "5", "", "1", "", "0"],  # NULL hours, census 0
    ["015010", "Beta Care", "ny", "2024-04-01", "6", "4", "4", "4", "", "", ""],  # census NULL
    ["015010", "Beta Care", "ny", "20240402", "6", "4", "4", "4", "", "", "10"],  # unparsable date
    ["   ", "Blank Key", "TX", "2024-04-01", "1", "1", "1", "1", "", "", "1"],  # blank key (kept)
    [None, "No Key", "TX", "2024-04-01", "1", "1", "1", "1", "", "", "1"],  # NULL key (dropped)
]

PROVIDER_HEADER = [
    "CMS Certification Number (CCN)", "Provider Name", "State", "City/Town",
    "Number of Certified Beds", "Average Number of Residents per Day",
    "Reported Total Nurse Staffing Hours per Resident per Day",
]
PROVIDER_LOAD_1 = [
    ["015009", " Alpha Home ", "AL", "Mobile", "100", "80", "4.5"],
    ["015010", "Beta Care", "NY", "Albany", "0", "30", "1"],  # zero beds; hours exactly 1
    ["015011", "Gamma House", "CA", "Fresno", "", "", "15"],  # beds missing; hours exactly 15
    ["015012", "Delta Place", "TX", "Austin", "50", "Not Available", "Not Available"],
    ["015013", "Epsilon Court", "AL", "Dothan", "10", "5", "3.0"],
    ["015014", "Zeta Lodge", "NY", "Utica", "10", "5", "8.0"],
    ["015015", "Eta Manor", "NY", "Ithaca", "10", "5", "6.0"],
]
PROVIDER_LOAD_2 = [
    ["015009", "Alpha Home", "AL", "Mobile", "120", "90", "5.5"],  # newer load wins
]

SKILLED_HEADER = ["CMS Certification Number (CCN)", "Provider Name", "State", "Measure Code", "Score"]
SKILLED_ROWS = [
    ["015009", "Alpha Home", "AL", "S_005_02_DTC_VOLUME", "60"],
    ["015009", "Alpha Home", "AL", "S_004_01_PPR_PD_VOLUME", "999"],
    ["015010", "Beta Care", "NY", "S_005_02_DTC_VOLUME", "Not Available"],
    ["015012", "Delta Place", "TX", "S_005_02_DTC_VOLUME", "25"],
    ["015012", "Delta Place", "TX", "S_005_02_DTC_VOLUME", "30"],  # same CCN twice in one load
    ["099999", "Only Skilled", "WA", "S_005_02_DTC_VOLUME", "10"],  # no provider row
]

FACILITY_HEADER = [
    "CMS Certification Number (CCN)", "Provider Name", "State",
    "Performance Period: FY 2022 Risk-Standardized Readmission Rate",
]
FACILITY_ROWS = [
    ["015009", "Alpha Home", "AL", "20.5"],
    ["015010", "Beta Care", "NY", "22.0"],
    ["015011", "Gamma House", "CA", "19.0"],
    ["015012", "Delta Place", "TX", ""],
    ["015013", "Epsilon Court", "AL", "18.0"],
    ["015014", "Zeta Lodge", "NY", "25.0"],
    ["015015", "Eta Manor", "NY", ""],  # missing rate inside the band
]

MDS_HEADER = ["CMS Certification Number (CCN)", "Resident type", "Measure Code"]
MDS_ROWS = [
    ["015009", "Long Stay", "401"],
    ["015009", "Long Stay", "402"],
    ["015009", "Short Stay", "403"],
    ["015010", "Long Stay", "401"],
    ["015012", "Short Stay", "401"],
]


def write_csv(folder: str, name: str, header, rows) -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])
    return path
