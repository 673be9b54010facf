"""Curated weighted terms of the subjects, in English, German, French and Spanish: the general vocabulary of each field.

A term matches at the start of a word and may go on ("encrypt" meets "encryption"); one that ends in a bar ends there
("fan|"), one that begins with an asterisk may stand inside a word ("*kabel"). Terms of a subject are grouped by weight: 2
for what hardly occurs outside the field, 0.6 for what needs company. What the words of a corpus say beyond these is
learned from hand labels (`subjects.learned_terms`); nothing here was taken from a corpus.
"""

from __future__ import annotations

TERMS: dict[str, dict[float, str]] = {
    "switching and routing": {
        2: """vlan, vxlan, spanning tree, spanning-tree, forwarding table, mac address, mac table, routing table, route table, routing protocol, static route, default route, default gateway, next hop,
            next-hop, ospf, bgp|, rip|, is-is, eigrp, mpls, vrf, vrrp, lacp, lldp, igmp, multicast, broadcast domain, broadcast storm, link aggregation, port channel, lag|, trunk port, layer 2, layer 3, subnet,
            arp |, autonomous system, route redistribution, equal-cost, ecmp, packet forwarding, switch fabric, fabric link, spine, leaf switch, bridge loop, routing loop, access list, acl|, qinq, adjacency,
            routing-tabelle, weiterleitungstabelle, weiterleitung, statische route, standardroute, nächster hop, subnetz, spannbaum, *routing,
            table de routage, commutateur, routeur, passerelle par défaut, sous-réseau, arbre recouvrant, saut suivant, acheminement,
            tabla de rutas, tabla de encaminamiento, encaminador, enrutador, enrutamiento, conmutador, puerta de enlace, subred, árbol de expansión, siguiente salto""",
        0.6: """route|, routes|, router, routing, switching, forwards, forwarding, trunk, uplink, prefix, neighbor, peer|, peers|, hop|, hops|, metric, convergence, converge, backbone, loop|, fabric, frames, bridge,
            leitweg, vermittlung, nachbar, pfad, chemin, voisin, vecino, ruta|, rutas|""",
    },
    "wireless": {
        2: """wireless, wi-fi, wifi, wlan, ssid, bssid, access point, antenna, radio channel, channel width, channel plan, roaming, roam|, roams|, beacon, probe request, airtime, band steering, 2.4 ghz, 5 ghz, 6 ghz, ghz band,
            signal strength, rssi, snr|, dbi|, transmit power, radar event, dfs|, site survey, coverage hole, mesh node, mesh link, backhaul, beamforming, mimo, client density, cell edge, cell overlap, spectrum, interference,
            funknetz, funkkanal, funkzelle, drahtlos, antenne, *antenne, sendeleistung, signalstärke, zugangspunkt,
            sans fil, sans-fil, canal radio, point d'accès, puissance d'émission, couverture radio, itinérance,
            inalámbric, canal de radio, punto de acceso, antena, potencia de transmisión, itinerancia, cobertura de radio""",
        0.6: """radio, channel, roamed, mesh, signal, coverage, cell|, cells|, noise floor, handset, stations, airwaves, overhear, kanal, funk, canal|, señal, cellule""",
    },
    "security": {
        2: """authenticat, authoriz, encrypt, decrypt, cipher, certificate, private key, public key, password, passphrase, credential, firewall, intrusion, intruder, attacker, attack, vulnerab, exploit, malware, ransomware,
            phishing, spoof, cve-, security patch, security advisory, hardening, 802.1x, radius server, tacacs, two-factor, multi-factor, access token, session token, brute force, brute-force, denial of service, breach, audit log,
            audit trail, quarantine, posture, zero trust, least privilege, tls|, ssl|, ipsec, signed firmware, secure boot, login attempt, failed login, lockout, trusted host, forged, tamper,
            angreifer, angriff, verschlüssel, zertifikat, kennwort, kennwörter, passwort, schwachstelle, sicherheitslücke, anmeldeversuch, schadsoftware, authentifizier,
            attaquant, attaque, chiffrement, chiffre|, chiffré, certificat, mot de passe, mots de passe, vulnérabilité, faille, pare-feu, authentifi, logiciel malveillant,
            atacante, ataque, cifrado, cifra|, contraseña, certificado|, certificados|, vulnerabilidad, cortafuegos, autentic, programa malicioso""",
        0.6: """secret|, secrets|, login, revoke, rotate the, patch|, patched, flaw, threat, leaked, advisory, token, keys|, hash, sitzung, session|, sesión""",
    },
    "law and licensing": {
        2: """liabilit, liable, indemnif, indemnit, warrant, licensor, licensee, license agreement, license terms, license grant, sublicens, subscription term, subscription agreement, contract, clause, governing law, governed by, jurisdiction,
            court|, courts|, damages, breach of contract, terminat, intellectual property, copyright, trademark law, patent, written notice, written consent, assignment of, confidential, entitlement, royalt, open source license, claims|, arbitration, 
            haftung, haftet, gewährleistung, garantie, lizenz, vertrag, gerichtsstand, rechtswahl, urheberrecht, kündigung, schadenersatz,
            responsabilité, licence, contrat|, contrats|, tribunal, tribunaux, droit applicable, droit d'auteur, dommages, résiliation,
            responsabilidad, licencia, contrato, tribunales, garantía, derechos de autor, ley aplicable, rescisión, indemniz""",
        0.6: """license|, licenses|, licensed, agreement, consent, title to, grants, law|, laws|, legal, obligation, party|, parties|, subscriber, invoice, seat|, rights|, fee|, fees|""",
    },
    "regulatory and safety": {
        2: """declaration of conformity, conformity, directive, regulatory, approval, type approval, fcc|, ce mark, ce marking, emission, class a device, class b, exposure limit, rf exposure, electric shock, hazard, injur, electrocution, grounding,
            earthing, grounded, protective earth, burns|, trained personnel, qualified personnel, qualified staff, weee, rohs, hazardous substance, recycl, disposal, dispose of, household waste, collection point, battery disposal, laser class, certified for sale, indoor use only, high voltage,
            safety standard, safety instruction, shielded cable, unplug, disconnect power, power cord,
            richtlinie, konformität, zulassung, grenzwert, entsorg, altgerät, hausmüll, stromschlag, verletzung, gefahr|, netzkabel, schutzleiter, störaussendung,
            conformité, directive |, homologation, mise au rebut, déchets, collecte, choc électrique, blessure, danger|, mise à la terre, débranche,
            conformidad, directiva, homologación, eliminación de, residuos, recogida, descarga eléctrica, lesion, peligro, puesta a tierra, desconecte, desenchuf""",
        0.6: """warning|, warning:, caution, safety, complies, compliance, certified, restricted, forbid, waste, label|, installer, outdoor, warnung, vorsicht, attention, aviso, advertencia""",
    },
    "power and cooling": {
        2: """power supply, power supplies, power budget, watt|, watts|, kilowatt, ampere, amps|, volt-ampere, redundant supply, fan|, fans|, fan tray, airflow, air flow, air intake, inlet, exhaust, front-to-back, front to back, overheat, temperature sensor,
            thermal, heat sink, heat|, cooling, cools, degrees celsius, degrees, ups|, rectifier, brownout, circuit breaker, breaker, poe|, power over ethernet, energy saving, energy consumption, power consumption, power draw, standby power, batteries, battery backup, load sharing, hot-swap,
            netzteil, stromversorgung, lüfter, kühlung, wärme, temperatur, überhitz, leistungsaufnahme, luftstrom,
            alimentation, ventilateur, refroidi, température, surchauffe, consommation électrique, flux d'air, puissance totale,
            fuente de alimentación, fuentes de alimentación, ventilador, refriger, temperatura, sobrecalent, consumo eléctrico, flujo de aire, vatio""",
        0.6: """supply|, supplies|, power|, shelf, rail|, rails|, warm|, warmer, hot|, spins, spin up, outage, energy, consumption, load|, strom, fuente|""",
    },
    "software and automation": {
        2: """api call, rest api, endpoint, webhook, script, python, playbook, ansible, terraform, automation, automate, command line, command-line, cli|, json, yaml, schema, software image, firmware image, upgrade, rollback, rolls back, release image, patch level,
            inventory export, import job, scheduled job, scheduler, cron, dashboard, management console, sdk|, library call, pipeline, template, polling, polls, telemetry export, snmp, syslog, drift, version control, configuration backup, http request, query parameter, status code,
            skript, schnittstelle, programm, automatisier, aktualisierung, datensätze, befehlszeile, vorlage, oberfläche,
            interface de programmation, automatis, mise à jour, ligne de commande, enregistrements, tableau de bord, modèle de configuration,
            interfaz, programa, automatiza, actualización, línea de comandos, registros, panel de control, plantilla""",
        0.6: """software, program, job|, jobs|, image|, export, import, field|, counter, calls|, call|, method|, request, code|, retries, retry, log|, logs|, compteurs, contadores, zähler""",
    },
    "optics and cabling": {
        2: """transceiver, optical, optic|, optics|, sfp, qsfp, fiber, fibre, single-mode, single mode, multimode, multi-mode, wavelength, nanometer, dbm|, db loss, insertion loss, link budget, receive power, patch cord, patch panel, patch cable, breakout, splice, connector, ferrule,
            bend radius, lc |, mpo|, copper cable, twisted pair, direct attach, dac cable, cat 6, category 6, cable length, cable run, strand, cladding, attenuation, lane|, lanes|, laser output,
            glasfaser, *faser, lichtwellenleiter, kupferkabel, *kabel, stecker, dämpfung, wellenlänge, empfangspegel, optisch,
            fibre optique, module optique, connecteur, câble, longueur d'onde, atténuation, épissure, jarretière,
            fibra, módulo óptico, conector, cable de cobre, cables de cobre, longitud de onda, atenuación, latiguillo, óptico""",
        0.6: """cable, cabling, cables, decibel, module|, modules|, latch, loss|, span|, spans|, copper, gigabit, plug|, module |, patch|""",
    },
    "sport and venues": {
        2: """stadium, arena, spectator, fans in, supporters, match day, matchday, kick-off, kickoff, half-time, halftime, referee, coach|, coaches|, players, player|, league, tournament, championship, season ticket, turnstile, scoreboard, replay, striker, goalkeeper,
            final whistle, grandstand, concourse, ticketing, ticket|, tickets|, box office, athlete, marathon, sprint, runner, club|, football, soccer, basketball, ice hockey, the pitch, seating, crowd, live event, 
            stadion, zuschauer, spieltag, anpfiff, spieler, trainer|, trainern, mannschaft, verein, schiedsrichter, drehkreuz, tribüne, eintrittskarte,
            stade, spectateur, jour de match, jour du match, joueur, entraîneur, équipe|, arbitre, coup d'envoi, tourniquet, billet, tribune, supporter,
            estadio, aficionado, espectador, partido, jugador, entrenador, árbitro, torneo, torno, entrada al estadio, grada, equipo local""",
        0.6: """game|, games|, team|, teams|, goal|, goals|, race|, match|, matches|, venue, gate|, gates|, seat|, seats|, half|, score, winner, season, camera, block|, spiel|, spiele|, match |, puertas""",
    },
    "health care": {
        2: """hospital, clinic|, clinics|, clinical, patient, nurse, nursing, doctor, physician, surgeon, surgery, surgical, operating room, operating theat, ward|, wards|, bedside, beds|, infusion, infusion pump, heart rate, heart monitor, vital sign, telemetry monitor, pharmacy, prescription, medication, dose|, doses|,
            diagnos, radiolog, x-ray, ultrasound, mri|, ct scan, medical, medicine, electronic health record, emergency department, intensive care, defibrillator, wheelchair, sterile, steriliz, laboratory sample, ambulance, admission,
            krankenhaus, klinik, patient, pflegekr, pflege, ärzt, arzt|, station |, infusion, rollstuhl, diagnose, medikament, röntgen, op-saal,
            hôpital, clinique, infirmi, médecin, médic, chirurg, perfusion, fauteuil roulant, ordonnance, soins, lit|, lits|, pompe à perfusion,
            hospital, clínica|, enfermer, paciente, médic, cirug, infusión, silla de ruedas, receta, cama|, camas|, urgencias, bomba de infusión""",
        0.6: """bed|, care|, pump, heart, monitors|, staff on, ward |, dictate, findings, images, screening, lab|, bombas, pompes, pumpen""",
    },
}


def split_terms(text: str) -> list[str]:
    """Terms of a list as they are looked for in text with single blanks."""
    terms = []
    for raw in text.split(","):
        term = " ".join(raw.split())
        if bare := term.strip("*| "):
            terms.append(("" if term.startswith("*") else " ") + bare + (" " if term.endswith("|") else ""))
    return list(dict.fromkeys(terms))
