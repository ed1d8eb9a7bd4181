"""Invoice texts of our own and what must come out of them."""

from datetime import date
from decimal import Decimal as D

RULE, THIN, THICK = "=" * 60, "─" * 60, "═" * 60


def invoice_text(vendor, bill_to, number, issued, due, po, items, subtotal, rate, tax, total):
    lines = ["", RULE, " " * 24 + "INVOICE", RULE, "", *vendor, "", THIN, "", "Bill To:", *bill_to, "",
             f"Invoice Number:  {number}", f"Invoice Date:    {issued}", f"Due Date:        {due}",
             f"PO Number:       {po}", "", THIN,
             f"{'Description':<35} {'Qty':>5} {'Unit Price':>12} {'Amount':>12}", THIN]
    lines += [f"{d:<35} {q:>5} {p:>12,.2f} {a:>12,.2f}" for d, q, p, a in items]
    lines += [THIN, f"{'Subtotal:':<54} {subtotal:>12,.2f}", f"{'Tax (' + rate + '%):':<54} {tax:>12,.2f}", THICK,
              f"{'TOTAL DUE:':<54} {total:>12,.2f}", THICK, "", "Payment Terms: Net 30",
              "Thank you for your business!", ""]
    return "\n".join(lines)


PLAIN = invoice_text(
    ["Harbor Paper Works", "12 Quay Road", "Portland, ME 04101", "Phone: (207) 555-0111",
     "Email: office@harborpaper.example.com"],
    ["Town of Millbrook", "5 Green Lane", "Millbrook, NY 12545"],
    "INV-2026-041", "2026-01-20", "2026-02-19", "PO-2026-0091",
    [("Envelopes C5 (box)", 4, 11.25, 45.00), ("Letter Tray", 3, 9.90, 29.70), ("Stapler", 1, 18.30, 18.30)],
    93.00, "8.00", 7.44, 100.44)

LARGE = invoice_text(
    ["Northwind Compute LLC", "77 Server Way, Floor 9", "Reno, NV 89501-1234", "Phone: (775) 555-0177",
     "Email: billing@northwindcompute.example.com"],
    ["Desert County - Schools", "1 Campus Drive", "Las Cruces, NM 88001"],
    "INV-2026-777", "2026-02-10", "2026-03-12", "MDOT-2026-11-0042",
    [("Rack Server 2U", 12, 2150.00, 25800.00),
     ("Installation and burn-in of racks (per unit)", 12, 95.50, 1146.00),
     ("Patch Cable 3m", 1500, 2.10, 3150.00)],
    30096.00, "8.25", 2482.92, 32578.92)

EXPECTED = {
    "plain": dict(
        invoice_number="INV-2026-041", invoice_date=date(2026, 1, 20), due_date=date(2026, 2, 19),
        po_number="PO-2026-0091", vendor=("Harbor Paper Works", "12 Quay Road", "Portland", "ME", "04101",
                                          "(207) 555-0111", "office@harborpaper.example.com"),
        bill_to=("Town of Millbrook", "5 Green Lane", "Millbrook", "NY", "12545"),
        items=[("Envelopes C5 (box)", D(4), D("11.25"), D("45.00")), ("Letter Tray", D(3), D("9.90"), D("29.70")),
               ("Stapler", D(1), D("18.30"), D("18.30"))],
        subtotal=D("93.00"), tax_rate=D("0.08"), tax_amount=D("7.44"), total_amount=D("100.44")),
    "large": dict(
        invoice_number="INV-2026-777", invoice_date=date(2026, 2, 10), due_date=date(2026, 3, 12),
        po_number="MDOT-2026-11-0042",
        vendor=("Northwind Compute LLC", "77 Server Way, Floor 9", "Reno", "NV", "89501-1234", "(775) 555-0177",
                "billing@northwindcompute.example.com"),
        bill_to=("Desert County - Schools", "1 Campus Drive", "Las Cruces", "NM", "88001"),
        items=[("Rack Server 2U", D(12), D("2150.00"), D("25800.00")),
               ("Installation and burn-in of racks (per unit)", D(12), D("95.50"), D("1146.00")),
               ("Patch Cable 3m", D(1500), D("2.10"), D("3150.00"))],
        subtotal=D("30096.00"), tax_rate=D("0.0825"), tax_amount=D("2482.92"), total_amount=D("32578.92")),
}
