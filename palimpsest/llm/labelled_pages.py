"""Labelled pages on which the page model is trained (problem 1).

The pages are written by a grammar of page furniture and of policy text in four languages, with a fixed seed, so that the
training set is a bounded, documented sample (`pages`). The grammar says what pages of the web carry in general; no line of
any table the operator runs over is written out in it. In a production {name} stands for one of the productions of that name, and
(a~b) for one of the choices; {x?} is left out half of the time.
"""

from __future__ import annotations

import random
import re

from palimpsest.llm.residue_exemplars import EXEMPLARS

# Items of site menus.
MENUS = {
    "en": "Home~Products~Services~Solutions~Pricing~Plans~Features~About~About us~Our story~Team~Company~Careers~Jobs~Press~Newsroom~News~Blog~Magazine~Events~Calendar~Webinars~Community~Forum~Partners~Affiliates~Resellers~Investors~Support~Help~Help centre~Help center~FAQ~Contact~Contact us~Contact sales~Store~Shop~Store finder~Locations~Stores~Gift cards~Gifts~Offers~Deals~Sale~New in~Bestsellers~Brands~Catalogue~Cart~Cart ({n})~Basket ({n})~Checkout~Wish list~My account~Account~My orders~Log in~Login~Log out~Sign in~Sign up~Register~Join~Search~Menu~Close~Skip to content~Skip to main content~Main menu~Developers~API~Documentation~Docs~Guides~Resources~Learn~Academy~Downloads~Status~Security~Trust~Legal~Privacy~Privacy center~Terms~Cookies~Accessibility~Sitemap~Language~English~Language: English~Country~For business~Business~Enterprise~Education~Customers~Case studies~Reviews~Gallery~Media~Sustainability~Donate~Subscribe~Newsletter~Get started~Try for free~Book a demo~What's new~All topics~More".split("~"),
    "de": "Startseite~Start~Produkte~Leistungen~Lösungen~Preise~Tarife~Angebote~Über uns~Unternehmen~Team~Karriere~Stellenangebote~Presse~Aktuelles~Neuigkeiten~Blog~Magazin~Termine~Veranstaltungen~Partner~Hilfe~Hilfe & Kontakt~Kundenservice~Kontakt~Shop~Filialen~Filialfinder~Händler~Gutscheine~Marken~Warenkorb~Warenkorb ({n})~Merkzettel~Mein Konto~Konto~Anmelden~Abmelden~Registrieren~Suche~Menü~Schließen~Zum Inhalt springen~Entwickler~Downloads~Sicherheit~Rechtliches~Impressum~Datenschutz~AGB~Barrierefreiheit~Sitemap~Sprache~Deutsch~Für Unternehmen~Geschäftskunden~Privatkunden~Newsletter~Investoren~Nachhaltigkeit~Ratgeber~Themen~Mehr".split("~"),
    "fr": "Accueil~Produits~Services~Solutions~Tarifs~Offres~À propos~Qui sommes-nous~Entreprise~Équipe~Carrières~Emplois~Recrutement~Presse~Actualités~Blog~Magazine~Événements~Agenda~Partenaires~Aide~Centre d'aide~Assistance~Contact~Nous contacter~Boutique~Boutiques~Magasins~Cartes cadeaux~Marques~Panier~Panier ({n})~Mes favoris~Mon compte~Compte~Connexion~Se connecter~Déconnexion~S'inscrire~Rechercher~Recherche~Menu~Fermer~Aller au contenu~Développeurs~Téléchargements~Sécurité~Mentions légales~Confidentialité~CGV~Accessibilité~Plan du site~Langue~Français~Professionnels~Particuliers~Newsletter~Investisseurs~Guides~Plus".split("~"),
    "es": "Inicio~Productos~Servicios~Soluciones~Precios~Tarifas~Ofertas~Sobre nosotros~Quiénes somos~Empresa~Equipo~Empleo~Trabaja con nosotros~Prensa~Noticias~Novedades~Blog~Revista~Eventos~Agenda~Socios~Ayuda~Centro de ayuda~Atención al cliente~Contacto~Tienda~Tiendas~Tarjetas regalo~Marcas~Carrito~Carrito ({n})~Favoritos~Mi cuenta~Cuenta~Iniciar sesión~Cerrar sesión~Registrarse~Buscar~Menú~Cerrar~Ir al contenido~Desarrolladores~Descargas~Seguridad~Aviso legal~Privacidad~Condiciones~Accesibilidad~Mapa del sitio~Idioma~Español~Empresas~Particulares~Boletín~Inversores~Guías~Más".split("~"),
}

_EN = {
    # the page around
    "top": ["{crumbs}", "{crumbs}", "{crumbs}", "{back}", "{cookie}", "{cookie}", "{cookie}", "{byline}", "{byline}", "{stamp}", "{stamp}", "{banner}"],
    "side": ["{related}", "{related}", "{related}", "{popular}", "{popular}", "{advert}", "{advert}", "{share}", "{share}", "{rating}", "{rating}", "{nearby}", "{offer}", "{next}", "{tags}"],
    "foot": ["{rights}", "{rights}", "{rights}", "{address}", "{address}", "{follow}", "{newsletter}", "{newsletter}", "{up}", "{build}", "{app}", "{links}", "{links}", "{region}", "{small}", "{small}", "{brands}", "{cookie}"],
    "crumbs": ["{start} {sep} {title}", "{start} {sep} {section} {sep} {title}", "{start} {sep} {section} {sep} {brand} {sep} {title}", "You are here: {start} {sep} {title}", "You are in: {section} {sep} {title}", "{section} {sep} {title}", "{section} ({n}) {sep} {title}", "{section}{slash}{word}{slash}{title}"],
    "slash": ["/", "\\", " \\ ", "::"],
    "start": ["Home", "Start", "Home page", "Main page", "{brand}"],
    "section": ["Legal", "Policies", "Help", "Support", "Help centre", "Legal centre", "Terms and policies", "About", "Resources", "Company", "Documents", "Trust centre", "All policies"],
    "back": ["(←~<~«~‹) Back to {section}", "(←~<) Back to (all~our) (policies~documents~articles~topics)", "← (Previous page~Return to overview~Overview)", "Back to the list"],
    "cookie": [
        "{site} (uses~stores~sets~places~relies on) {cookies} {why?}. {consent}", "{site} (uses~stores~sets) {cookies} {why}. By (continuing to browse~using this site~staying on this page~clicking “Accept”) you (agree~consent) to (this~our use of cookies~that). {buttons?}", "Cookie (settings~preferences~notice~consent): {ckinds}. {buttons}", "{ckinds}: (always on~on~off). {buttons}",
        "(Your privacy matters~We value your privacy~We respect your privacy~Your privacy, your choice~Your choices about cookies). {buttons}", "We and our {n?} partners (store~access~read) (cookies~data~information) on your (device~browser~screen) {why?}. {consent?}", "(Accept~Allow) (all~cookies)? {buttons}", "Manage (cookies~consent~choices~preferences) {arrow?}", "(Some~These~Other) cookies (need~require) your (consent~permission). {consent}",
        "Before you (continue~go on~start~read on): {we} (set~use~place) {cookies} {why?}. {buttons}", "Can {we} (set~store~use) {cookies} {why?}? {buttons}", "By clicking (“Accept all”~\"Accept\"~“OK”~“Agree”), you (let us~allow us to~agree that we) (set~store~use) {cookies} {why?}.", "Tracking (preferences~settings~choices): {ckinds}. {buttons}", "(Tracking~Cookies~Personalised ads) (is~are) (on~off~active). {consent}", "Choose (your cookies~which cookies you allow~your level of privacy): {ckinds}. {buttons}", "{we} would like to (remember your visit~measure your visit~place cookies). {buttons}",
    ],
    "site": ["We", "This site", "This website", "Our website", "Our site", "This page", "{brand}", "{brand} and its partners", "We and our partners", "We and {n} partners", "Our {word} partners"],
    "we": ["we", "we and our partners", "we and {n} partners", "our partners"],
    "cookies": ["cookies", "cookies and similar technologies", "cookies and pixels", "cookies and tags", "small files", "a few cookies", "trackers", "{word} cookies"],
    "why": ["to {purpose}", "to {purpose} and (to )?{purpose}", "for {topic} and {topic}", "so that we can {purpose}"],
    "consent": ["{buttons}", "{buttons}", "Learn more", "More", "Manage consent {arrow?}", "Read our cookie (policy~notice).", "OK?", "Details"],
    "buttons": ["{button}", "{button} | {button}", "[{button}] [{button}]", "{button} / {button}", "{button} - {button}", "{button} {button}", "[{button}]", "{button}, {button}"],
    "button": ["Accept", "Accept all", "Allow all", "Reject", "Reject all", "Decline", "Only necessary", "Settings", "Cookie settings", "Preferences", "Customise", "Manage", "Manage options", "OK", "Got it", "I agree", "Agree", "Not now", "No thanks", "Save", "Save and close", "Confirm choices", "Options", "More information", "Close", "✕", "X"],
    "ckinds": ["{ckind}, {ckind}", "{ckind} / {ckind} / {ckind}", "{ckind} | {ckind}", "{ckind} (always on), {ckind}, {ckind}"],
    "ckind": ["necessary", "strictly necessary", "essential", "functional", "analytics", "statistics", "performance", "marketing", "advertising", "personalisation", "social media", "preferences", "all", "{word}"],
    "byline": ["By {person}", "By {person} | {date}", "By {person}, {role}", "Written by {person}", "Posted by {person} (on~in) {date}", "(Published~Posted) {date} by {person}", "From the {brand} (editorial team~newsroom~policy team)", "By the {brand} (team~staff~editors~desk), {n} min read", "{person} · {date}", "{n} min read", "Reading time: {n} minutes", "Author: {person}", "(Edited~Reviewed~Checked) by: {person}", "(Article~Page) (reviewed~checked~approved) by the {topic} team"],
    "role": ["editor", "staff writer", "legal team", "policy team", "{brand} staff"],
    "stamp": ["(Last updated~Updated~Last modified~Published~Last reviewed~Last viewed~First published~Printed)(:~ on~) {date}", "(Viewed~Read~Visited~Downloaded) {n} times", "{n} (views~reads~visits~shares~downloads)", "Page (ID~no.~number) {n}", "Article {n} of {n}", "Version {n}.{n} | {date}", "Page {n} of {n}", "{date} | {n} (views~comments)"],
    "banner": ["[Banner]", "[Banner {n} x {n}]", "[Image]", "[Logo]", "Advertisement", "- Advertisement -", "Ad", "Slide {n} of {n}", "Menu ☰", "New: {topic} in {brand}. Learn more {arrow?}"],
    "related": ["(Related~Related articles~See also~Read also~Read next~Read more~More like this~Recommended~Recommended for you~Suggested~Further reading)(:~ {arrow}) {teaser}", "You (may~might) also (like~be interested in)(:~ {arrow}) {teaser}", "(Watch~See) (the~our) (video~tour~demo) ({n}:{n})", "(Up next~Next article~Continue reading) {arrow} {teaser}", "(People~Others) also (read~viewed~bought): {teaser}"],
    "teaser": ["{teaser_title}", "{teaser_title}", "{teaser_title}, part {n}", "{brand}: {topic}", "{brand}, our {word} plan", "a guide to {topic}"],
    "teaser_title": ["{topic} in {brand}", "{brand} guide", "The {brand} guide to {topic}", "How to {purpose}", "{n} tips for {topic}", "What is {topic}?", "{topic} explained", "{Topic} and {topic}", "{title}", "{head}", "{head}"],
    "popular": ["(Popular~Most popular~Most read~Trending~Trending now~Top stories~Hot topics~Latest~Latest news~In the news)(:~ this week:~ today:) {teaser}", "(Popular topics~Topics~Tags~Categories): {topic}, {topic}, {brand}", "Trending #{brand} #{word}", "Most read: {title}"],
    "tags": ["Tags: {topic}, {topic}", "Tags: {word}, {topic}, {brand}", "Filed under: {topic}", "#{word} #{word} #{brand}", "Categories: {topic} | {topic}"],
    "next": ["Next (article~page~post) {arrow}", "Next {arrow} {title}", "(<~«~←) (Previous~Prev)(: {title}~)", "(<~«) Previous | Next (>~»)", "Next: {title}", "(Next~Next article) {arrow} {head}", "(<~«) Previous: {head}"],
    "advert": ["(Advertisement~Ad~Sponsored~Promoted~Promotion)(:~ |~ -) {offer}", "Sponsored by {brand}", "{offer}", "[Ad {n}x{n}]", "Paid content"],
    "offer": ["(Try~Get~Test) {brand} (free for {n} days~for free~today~now)", "Save {n}% (on~with) {brand} {topic?}", "{brand}: {n}% off (all~your first) (orders~order~plans)", "{brand} from (${n}~{n} credits~€{n}) (a month~per month~- buy now~- order today)", "(Start your~Get a) free trial", "(Buy~Order~Book) now", "Free (delivery~shipping) on orders over ${n}"],
    "nearby": ["(Jobs~Work) (at {brand}~near you~with us): {topic} (manager~engineer~lead) (wanted~in {brand}~at {brand})", "We are hiring: {topic} (manager~lead)", "(Next~Upcoming) (webinar~event~course)(:~ about~ on) {topic}(: register now~ - register~, {date})", "(Download~Get) our (free ~)(report~guide~e-book~white paper~brochure) (on~about) {topic} (\\(PDF, {n} MB\\)~\\(PDF\\)~here)", "Register for our (event~webinar) on {topic}", "Store finder: find a shop near you"],
    "share": ["Share", "Share this (page~article~post)", "Share this (page~article)(:~ on) {networks}", "Share (on~via) {networks}", "{networks}", "(Print~Print this page)(  ~ | ~ / )(Save as PDF~PDF~Download)(  ~ | ~ / )(E-mail~Send by mail~Email)", "Copy link", "(Tell~Invite) (a friend~your friends)", "Like this (page~article)? (Share it~Tell a friend~Pass it on)", "{n} shares", "Share {arrow?} {n} (shares~likes)", "(Print~Save~Bookmark) this page", "Share on your (network~favourite network~social media)"],
    "networks": ["{net} {net} {net}", "{net} | {net} | {net}", "{net} · {net}", "{net} / {net} / {net}"],
    "net": ["Facebook", "Twitter", "X", "LinkedIn", "WhatsApp", "Email", "E-mail", "Mail", "Copy link", "Link", "Reddit", "Pinterest", "Post", "Telegram", "Print"],
    "rating": ["(Was~Is) this (page~article~information~answer) (helpful~useful)? (Yes / No~Yes | No~Yes No~👍 👎~)", "(Rate~Please rate) this (page~article~answer) (★★★★★~★★★★☆~☆☆☆☆☆~1 2 3 4 5) (\\({n} votes\\)~\\({n} ratings\\)~)", "{n} (people~of {n} people~readers) found this (helpful~useful)(. Did you?~.~)", "(Rating~Rated): {n}.{n} (of 5~/ 5~stars)", "(Did~Do) you (like~find) this (page~article~useful)? (Tell us~Give feedback~Let us know)", "(Send~Give~Leave) (us ~)feedback", "Comments ({n})", "Comments ({n}) - (Log in~Sign in) to (reply~comment~post)", "{n} comments | (Add a comment~Reply~Write a comment)", "(Leave~Write) a (comment~reply~review)", "Need help? (Chat with us~Call us~Ask our team)( 24/7~ now~)", "(Live chat~Chat now~Ask a question)"],
    "rights": ["© {year} {brand}", "© {year} {brand}. All rights reserved.", "Copyright (© ~){year} {brand} (Inc.~Ltd.~Group~GmbH~LLC~)(. All rights reserved.~ - all rights reserved~)", "© {year}-{year} {brand} {brand}", "All rights reserved. {brand} {year}", "{brand} (is a (registered ~)trademark of~and its logo are trademarks of) {brand}", "(All ~)(prices~Prices) (include~incl.) (VAT~tax)(. Images may (differ~vary)~, plus delivery~). © {year} {brand}"],
    "address": ["{brand} (Ltd.~Inc.~GmbH~Group), {n} {brand} (Street~Road~Row~Avenue~Lane)(, {brand}~)(, registered (under~in~no.) {code}~)", "{brand} (Ltd~Inc), company (no.~number) {code}", "(Registered office~Head office~Headquarters): {n} {brand} (Street~Road)", "VAT (no.~ID) {code}", "Tel. {n} {n} | (E-mail~Mail) {word}@{word}.com", "(Made~Built~Designed) (with (love~♥)~) (in~by) {brand}", "Phone: +{n} {n}"],
    "brands": ["{brand}(,~ is) (a ~)(part~member) of the {brand} (group~family)( of (brands~companies)~)", "A {brand} (company~brand)", "{brand} {brand}, a {brand} brand", "Powered by {brand}", "Hosted by {brand}", "(Secure~Safe) (checkout~payment) (with~by) {brand}", "Visa Mastercard PayPal"],
    "follow": ["Follow us", "Follow us(:~ on) {networks}", "(Find~Join) us on {networks}", "Connect with us: {networks}", "Follow {brand}: (photos~videos~posts) / (videos~news~feed)"],
    "newsletter": ["(Subscribe to~Sign up for~Join) our newsletter", "(Subscribe to~Sign up for) our newsletter(:~ -~.) (enter your e-mail~your e-mail address~Get news and offers) ([Subscribe]~Subscribe~[Sign up]~)", "Get (the latest~our) (news~offers~updates) (in your inbox~by e-mail)", "(Enter~Type) your e-mail (address~) (Subscribe~[OK]~)", "Never miss an update. (Subscribe~Sign up)"],
    "up": ["Back to top", "Back to top ↑", "Top ↑", "↑ (Top~Up)", "Scroll to top"],
    "build": ["v{n}.{n}.{n}", "(Version~Release) {n}.{n}.{n} (build {code}~)", "v{n}.{n} build {code}", "Build {code}", "Site version {n}.{n}"],
    "app": ["(Download~Get) (the~our) app( for (phones~iOS and Android~your phone)( and tablets~)~)", "Get it on Google Play", "Download on the App Store", "Available for (iOS and Android~phones and tablets)", "(Mobile~Desktop) (version~site)( | (Mobile~Desktop) (version~site)~)"],
    "links": ["{lk} | {lk} | {lk}", "{lk} · {lk} · {lk}", "{lk} | {lk}", "{lk}  {lk}  {lk}", "{lk} - {lk} - {lk}", "{lk} / {lk}", "{lk} | {lk} | {lk} | {lk}"],
    "lk": ["Privacy", "Terms", "Terms of use", "Imprint", "Legal notice", "Cookies", "Cookie settings", "Accessibility", "Sitemap", "Site map", "Contact", "Careers", "Jobs", "Press", "About", "Help", "Do not sell my data", "Do not sell my personal information", "Your privacy choices", "Licences", "Feedback", "Security"],
    "region": ["(Change~Select~Choose) (your ~)(region~country~language)(:~) (Europe | Asia | Americas~North | South~English | Deutsch | Français~)", "(Region~Country~Language): (English~Europe~United Kingdom~International)", "English | Deutsch | Français | Español"],
    "small": ["This (site~website) (works best~is best viewed) (with~in) a (current~modern~recent) browser(.~)", "Best viewed in {brand}", "All prices include (tax~VAT)(. Images may vary~). ", "(Contains~May contain) affiliate links", "{n} visitors online", "This site is protected by reCAPTCHA", "(Loading~Please wait)"],
    "arrow": ["→", "»", "›", "▸", ">", "▾"],
    "sep": [">", "»", "/", "›", "▸", "→", "|", "::"],
    "title": ["{doc}", "{doc}", "{doc} (policy~notice~terms~statement~rules~overview~guidelines~faq~annex~{n})", "{Topic}", "{word} (policy~notice~terms~rules)"],
    "doc": ["Privacy", "Privacy policy", "Cookie policy", "Cookie notice", "Terms of use", "Terms of service", "Terms and conditions", "Refund policy", "Returns", "Shipping", "Delivery", "Acceptable use", "Community guidelines", "Copyright", "Data processing", "Data retention", "Security", "Accessibility", "Licence", "Payments", "Subscriptions", "Warranty", "Seller terms", "Developer terms", "Child safety", "Advertising policy"],
    # the main text
    "head": ["{Topic}", "{Topic} and {topic}", "About {topic}", "(How~When~Why) we {verb} {topic}", "What (we {verb}~happens to {topic}~you can do~this (policy~document) covers)", "Your (rights~choices~obligations~options~duties)( (about~in) {topic}~)", "(Rights~Duties~Obligations~Limits~Rules) (of~for) {who}", "{doc} in {brand}", "(Use~Storage~Sharing~Deletion~Transfer~Retention~Limits) of {topic}", "(Use of~About~Using) {brand}", "{word} (rules~terms~provisions~rights)", "(Annex~Schedule~Part) {n}( to~:) {word} (terms~rules)", "(Requests~Appeals~Objections~Complaints) (about~on) {topic}", "Changes to (this policy~these terms~{topic})", "(Definitions~Scope~Purpose~Introduction~Liability~Contact~Governing law~Termination~Complaints~Retention periods~Legal basis~Children~Summary)", "Who we are", "If you (close your account~disagree~move~cancel)", "{Topic}: {brand}", "Fees (and~for) {topic}", "{word} {topic}", "Cookies (for~and) {topic}", "(Sharing~Printing~Rating) {topic}"],
    "item": ["{topic}", "the {topic}", "your {topic}", "{word} {topic}", "{topic} and {topic}", "(to )?{purpose}", "{verb} {topic} {cond?}", "{topic} (linked to~sent through~about) {brand}", "whether you {vyou}", "(name~contact~withdraw~object to~ask for) (a person~us~consent~{topic})", "any {topic} of your household", "(cookies~menus~shared links) for {topic}"],
    "clause": ["{sentence}", "{sentence}", "{sentence} {sentence}", "{sentence} {sentence} {sentence}"],
    "sentence": [
        "{Who} {modal} {verb} {topic} {cond}.", "{Who} {modal} {verb} {topic} {cond}.", "We {verb} {topic} {cond}.", "We {verb} {topic} {why}.", "{Cond}, {who} {modal} {verb} {topic}.", "{Cond}, we {verb} {topic} {why}, {cond}.", "{Topic} {modal} be {verbed} {cond}.", "{Topic} (is~are) {verbed} {cond}.", "{Who} {modal} {verb} {topic}, and {who} {modal} {verb} {topic} {cond}.", "{Who} {modal} not {verb} {topic} {cond}.", "Under (section~article~clause) {n}(.{n}~), {who} {modal} {verb} {topic} {why}.",
        "(From~Since~As of) {date} {topic} {modal} be {verbed} {cond}.", "(This policy~This document~This notice~These terms) (applies~apply~is part of~are part of) {topic} (of~in) {brand}.", "The (term~word) \"{topic}\" (means~refers to) {topic} {cond}.", "(Questions~Complaints~Requests) about {topic} (go to~are answered by~can be sent to) {who}(, reference {code}~) {cond?}.", "(If~Where) two versions (differ~disagree), the {word} one (prevails~counts).", "The {word} plan of {brand} includes {n} {topic}, of which {n} {modal} {verb}.", "(Words~Terms) in (bold~capitals~brackets) are (defined~explained) in (annex~section~part) {n}.", "Nothing in (this document~these terms) limits {topic} (of~that) {who}.",
        "You {modal} {vyou} {cond}; see our {word} terms for the details.", "{Who} (must~may~should) be at least {n} years old.", "The fee (is~rises by~is reduced by) {n}% (for~of) {topic} (case {code})?.", "{brand} is not liable for {topic} {cond}.", "(Cookies~Tags~Scripts) (set by~from) {brand} are {verbed} {cond}.", "(You can~Use the menu of {brand} to) (share~print~rate~see) {topic} {cond}.", "(Comments~Reviews~Ratings) (on~about) {topic} are {verbed} {cond}.", "If you subscribe to (a newsletter~{topic}), we {verb} {topic} until you (cancel~unsubscribe~object).", "Follow the {word} rules of {brand} when you share {topic}.", "Content marked © (belongs to~is owned by) {who}.", "We {verb} (cookies~trackers) only {cond}, and you {modal} {verb} them in the settings.", "The {word} (office~desk~team) last (checked~reviewed) this document on {date}.",
        "Access {modal} be {verbed} if an error occurs or a page is not found.", "{Who} {modal} {verb} {topic} and {verb} {topic} {why} (case {code}):", "(Copyright~Privacy) law {modal} {verb} {topic} {cond}.",
    ],
    "Who": ["We", "You", "Users", "Customers", "Members", "Sellers", "Developers", "Parents", "Guests", "All users", "Each seller", "Our teams", "Our partners", "{brand}", "Group companies", "Reviewers", "The {word} team", "Any user of {brand}", "Account holders", "Service providers", "Third parties", "Courts", "The authorities"],
    "who": ["we", "you", "users", "customers", "members", "sellers", "developers", "parents", "guests", "all users", "our teams", "our partners", "{brand}", "group companies", "the {word} team", "the data protection officer", "service providers", "third parties", "the authorities", "members of {brand}"],
    "modal": ["may", "must", "can", "will", "should", "might", "shall", "cannot", "have the right to", "are free to", "agree to", "are allowed to", "need to"],
    "verb": ["collect", "use", "store", "share", "process", "keep", "delete", "transfer", "disclose", "request", "access", "correct", "review", "publish", "limit", "block", "check", "combine", "export", "forward", "refuse", "change", "protect", "measure", "archive", "sell", "index", "copy", "accept", "cancel", "renew", "refund", "report", "update", "inspect", "log", "restrict", "explain", "document", "remove"],
    "verbed": ["collected", "used", "stored", "shared", "processed", "kept", "deleted", "transferred", "disclosed", "reviewed", "published", "limited", "blocked", "checked", "combined", "exported", "refused", "changed", "archived", "sold", "copied", "cancelled", "renewed", "refunded", "logged", "removed", "denied", "explained", "set", "locked"],
    "vyou": ["close your account", "withdraw your consent", "move to another country", "buy {topic}", "delete your profile", "change your settings", "opt out of {topic}", "contact us", "ask for a copy of {topic}", "use {brand}", "appeal a decision"],
    "cond": ["within {n} days", "for {n} (days~months~years)", "on request", "where the law (requires~allows) (it~this)", "if you (consent~agree)", "if you {vyou}", "unless you {vyou}", "as long as you {vyou}", "after you {vyou}", "until {date}", "before {date}", "when you {vyou}", "at any time", "without notice", "by post", "in writing", "for the purposes of {topic}", "every {n} weeks", "no later than {date}", "because the law (of your country ~)(asks~requires) us to {purpose}", "in {brand}", "at the end of the {word} period", "even if you {vyou}"],
    "Cond": ["If you {vyou}", "When you {vyou}", "Once you {vyou}", "Where the law requires it", "After {n} days", "Unless you {vyou}", "Before you {vyou}", "As soon as you {vyou}", "For {topic}", "In the {word} release of {brand}", "From {date}", "As long as you {vyou}", "In some countries"],
    "purpose": ["improve {topic}", "prevent (fraud~abuse~spam)", "provide our services", "answer your questions", "process {topic}", "comply with the law", "measure visits", "show you relevant ads", "personalise content", "resolve disputes", "keep our services safe", "test new features", "detect misuse", "protect minors", "analyse traffic", "remember your settings", "meet our obligations", "develop products", "verify your identity"],
    "word": ["new", "local", "joint", "annual", "monthly", "weekly", "shared", "basic", "public", "regional", "internal", "encrypted", "manual", "daily", "former", "family", "temporary", "general", "additional", "personal", "technical", "partial", "premium", "standard", "legal", "privacy", "support", "audit", "safety", "quality", "billing", "security", "delivery", "research", "identity", "seller", "trust"],
    "topic": ["personal data", "account data", "payment details", "orders", "messages", "devices", "location data", "contact lists", "photos", "invoices", "subscriptions", "refunds", "deliveries", "reviews", "listings", "ads", "cookies", "log files", "backups", "crash reports", "search history", "purchase history", "support requests", "complaints", "warranty claims", "device settings", "time zones", "e-mail addresses", "phone numbers", "delivery addresses", "age checks", "user profiles", "group chats", "calls", "file uploads", "sign-ins", "page visits", "location history", "voice recordings", "calendar entries", "consent records", "contracts", "prices", "credits", "gift cards", "loyalty points", "receipts", "passwords", "security reports", "parcel tracking", "usage statistics", "surveys", "third-party services", "intellectual property", "disputes", "renewals", "taxes", "fees", "api keys"],
    "person": ["{brand} {brand}", "{brand} {brand}", "the {word} team", "{brand}"],
}

_DE = {
    "top": ["{start} {sep} {doc}", "{start} {sep} {section} {sep} {doc}", "Sie (sind~befinden sich) hier: {start} {sep} {doc}", "{cookie}", "{cookie}", "{cookie}", "{byline}", "{byline}"],
    "side": ["(Mehr zum Thema~Das könnte Sie (auch ~)interessieren~Lesen Sie auch~Ähnliche (Artikel~Themen)~Empfohlen)(:~ ») {topic} (in {brand}~)", "(Meistgelesen~Beliebt~Beliebte Themen~Aktuell): {topic}( in {brand}~)", "(Anzeige~Werbung)(:~ -) {brand} (jetzt~{n} Tage) (testen~gratis testen~kostenlos testen)", "(Seite~Artikel) (teilen~drucken)(:~) ({net} | {net}~{net}~)", "War diese (Seite~Information~Antwort) hilfreich? Ja / Nein", "(Drucken~Seite drucken)(  ~ | )(Als PDF speichern~PDF~Per E-Mail senden)", "Kommentare ({n})", "{n} Leser fanden das hilfreich", "Nächster Artikel » {topic}", "Jobs bei {brand}: {topic}"],
    "foot": ["© {year} {brand}. Alle Rechte vorbehalten(.~)", "Copyright {year} {brand} GmbH", "{lk} | {lk} | {lk}", "{lk} · {lk}", "Nach oben ↑", "Zum Seitenanfang", "Newsletter (abonnieren~bestellen)(: (E-Mail~Ihre E-Mail-Adresse) eingeben~)", "Folgen Sie uns(: {net} / {net}~ auf {net})", "Alle Preise inkl. MwSt.", "{brand} GmbH, {brand}straße {n}", "App (herunterladen~laden)", "Sprache: Deutsch", "Ein Unternehmen der {brand}-Gruppe"],
    "cookie": ["(Diese (Website~Seite)~Unsere Website) (verwendet~speichert~nutzt~setzt) Cookies(, um {purpose}~). {buttons}", "Wir (verwenden~nutzen~setzen) Cookies(, um {purpose}~). {buttons}", "(Cookie-Einstellungen~Ihre Privatsphäre~Datenschutzeinstellungen)(: Dürfen wir (und {n} Partner ~)Cookies setzen?~. {buttons})", "Mit {n} Partnern speichern wir Daten auf Ihrem Gerät. {buttons}", "Durch die (weitere ~)Nutzung stimmen Sie der Verwendung von Cookies zu. {buttons}"],
    "buttons": ["{button}", "{button} | {button}", "[{button}] [{button}]", "{button} {button}"],
    "button": ["Alle akzeptieren", "Akzeptieren", "Ablehnen", "Alle ablehnen", "Einstellungen", "OK", "Zustimmen", "Nur notwendige", "Mehr erfahren", "Auswahl speichern", "Schließen"],
    "byline": ["Von (der ~){brand}( {brand}~)(-Redaktion~)(, {date}~)", "(Veröffentlicht~Aktualisiert~Zuletzt aktualisiert~Stand)(:~ am) {date}", "(Geprüft~Freigegeben) (vom Team {topic}~von {brand} {brand})(, Seite {n}~)", "Lesezeit: {n} Minuten", "{n} Mal gelesen"],
    "start": ["Start", "Startseite", "Home"],
    "section": ["Rechtliches", "Hilfe", "Service", "Unternehmen"],
    "lk": ["Impressum", "Datenschutz", "AGB", "Barrierefreiheit", "Kontakt", "Karriere", "Presse", "Sitemap", "Cookie-Einstellungen"],
    "net": ["Facebook", "Mail", "E-Mail", "Link kopieren", "WhatsApp", "Bilder", "Videos", "Instagram"],
    "doc": ["Datenschutz", "Datenschutzerklärung", "Nutzungsbedingungen", "AGB", "Widerruf", "Privacy policy", "Cookies notice", "Lieferung"],
    "purpose": ["{topic} zu verbessern", "Inhalte zu personalisieren", "Betrug zu verhindern", "Zugriffe zu messen", "{brand} zu verbessern"],
    "head": ["{topic}", "{topic} und {topic}", "(Umgang mit~Pflichten zu~Rechte an~Dauer der~Regeln für) {topic}", "Ihre Rechte", "Wie wir {topic} verarbeiten", "Änderungen dieser Erklärung", "Geltungsbereich", "{topic} in {brand}", "{topic} ({brand})"],
    "item": ["{topic}", "die {topic}", "alle {topic}", "Ihre {topic}", "{topic} und {topic}"],
    "clause": ["{sentence}", "{sentence} {sentence}"],
    "sentence": ["{Wer} {verb} {topic} {cond}.", "{Cond} {verb} wir {topic}, {neben}.", "{topic} werden {cond} {verbed}.", "{Wer} {darf} {topic} {cond} {inf}.", "{neben2}, können Sie {topic} {cond} {inf}.", "Fragen zu {topic} beantwortet {wer}.", "Nach § {n} {darf} {wer} {topic} {inf}.", "Die Frist für {topic} beträgt {n} Tage.", "Cookies von {brand} werden {cond} {verbed}."],
    "Wer": ["Wir", "Sie", "Unsere Partner", "Die Abteilung", "{brand}", "Jeder Kunde", "Alle Nutzer"], "wer": ["unser Team", "die Abteilung", "{brand}", "der Anbieter"],
    "verb": ["speichern", "nutzen", "löschen", "prüfen", "übermitteln", "erheben", "verarbeiten", "sperren"], "inf": ["speichern", "nutzen", "löschen", "prüfen", "übermitteln", "ändern", "einsehen", "verlangen"],
    "verbed": ["gespeichert", "gelöscht", "verarbeitet", "geprüft", "übermittelt", "gesperrt", "erhoben"], "darf": ["darf", "dürfen", "kann", "können", "muss", "müssen"],
    "cond": ["innerhalb von {n} Tagen", "auf Anfrage", "nur mit Ihrer Einwilligung", "nach {n} Monaten", "spätestens am {date}", "jederzeit", "für {n} Jahre", "im Rahmen der Gesetze"],
    "Cond": ["Mit Ihrer Einwilligung", "Ab dem {date}", "Nach {n} Tagen", "In diesem Fall"], "neben": ["wenn Sie zustimmen", "soweit das Gesetz es verlangt", "falls Sie kündigen"], "neben2": ["Wenn Sie zustimmen", "Sobald das Konto gelöscht ist", "Falls {topic} vorliegen", "Soweit das Gesetz es erlaubt"],
    "topic": ["Daten", "Vertragsdaten", "Zahlungsdaten", "Bestellungen", "Nachrichten", "Gerätedaten", "Rechnungen", "Rückgaben", "Lieferadressen", "Beiträge", "Verträge", "Protokolle", "Nutzungsdaten", "Beschwerden", "Gebühren", "Kontodaten", "Altersangaben", "Fotos", "Belege"],
}

_FR = {
    "top": ["{start} {sep} {doc}", "{start} {sep} {section} {sep} {doc}", "Vous êtes ici : {start} {sep} {doc}", "{cookie}", "{cookie}", "{cookie}", "{byline}", "{byline}"],
    "side": ["(À lire aussi~Lire aussi~Voir aussi~À découvrir~Articles liés~Recommandé pour vous)( :~ ») {topic}( dans {brand}~)", "(Les plus lus~Populaire~Sujets du moment~À la une) : {topic}", "(Publicité~Annonce)( :~ -) (essayez~découvrez) {brand} ({n} jours~gratuitement~)", "Partager (cette page~cet article)( : {net} | {net}~ sur {net}~)", "Cette (page~réponse~information) vous a-t-elle été utile ? Oui / Non", "(Imprimer~Imprimer cette page)(  ~ | )(Enregistrer en PDF~PDF~Envoyer par e-mail)", "Commentaires ({n})", "{n} lecteurs ont trouvé cela utile", "Article suivant » {topic}"],
    "foot": ["© {year} {brand}. Tous droits réservés(.~)", "Copyright {year} {brand} SA", "{lk} | {lk} | {lk}", "{lk} · {lk}", "Haut de page ↑", "Retour en haut", "(Abonnez-vous à~Inscrivez-vous à) notre (lettre~newsletter)( : votre (e-mail~adresse)~)", "Suivez-nous( : {net} / {net}~ sur {net})", "Tous nos prix sont TTC", "{brand} SA, {n} rue {brand}", "Télécharger l'application", "Une société du groupe {brand}"],
    "cookie": ["(Ce site~Notre site~Cette page) (utilise~dépose~enregistre) des (cookies~traceurs)( pour {purpose}~). {buttons}", "Nous (utilisons~déposons) des cookies( pour {purpose}~). {buttons}", "(Nous et nos {n} partenaires~{n} partenaires) (souhaitons~souhaitent) (lire~déposer) des traceurs sur votre (appareil~navigateur). {buttons}", "(Votre vie privée~Gestion des cookies~Vos choix) : {buttons}", "En poursuivant votre navigation, vous acceptez les cookies. {buttons}"],
    "buttons": ["{button}", "{button} | {button}", "[{button}] [{button}]", "{button} {button}"],
    "button": ["Tout accepter", "Accepter", "Accepter ?", "Refuser", "Tout refuser", "Réglages", "Paramétrer", "OK", "Continuer sans accepter", "En savoir plus", "Fermer"],
    "byline": ["Par (la rédaction de ~){brand}( {brand}~)(, le {date}~)", "(Publié~Mis à jour)( le~ :) {date}", "(Relu~Vérifié~Page relue) par (l'équipe {topic}~{brand} {brand})(, n° {n}~)", "Temps de lecture : {n} minutes", "Lu {n} fois"],
    "start": ["Accueil", "Page d'accueil"], "section": ["Juridique", "Aide", "Entreprise"],
    "lk": ["Mentions légales", "Confidentialité", "CGV", "Accessibilité", "Plan du site", "Contact", "Presse", "Carrières", "Gérer les cookies"],
    "net": ["Facebook", "courriel", "e-mail", "copier le lien", "WhatsApp", "photos", "vidéos", "lien"],
    "doc": ["Confidentialité", "Politique de confidentialité", "Conditions d'utilisation", "Cookies", "Livraison", "Retours", "Privacy policy"],
    "purpose": ["améliorer {topic}", "améliorer {brand}", "mesurer l'audience", "prévenir la fraude", "personnaliser le contenu"],
    "head": ["Vos droits", "Les {topic}", "(Règles sur~Usage de~Conservation de) vos {topic}", "Durée de conservation : {topic}", "Modifications de ces conditions", "{topic} et {topic}", "Vos {topic} dans {brand}"],
    "item": ["{topic}", "les {topic}", "vos {topic}", "{topic} et {topic}"],
    "clause": ["{sentence}", "{sentence} {sentence}"],
    "sentence": ["{Qui} {verb} {topic} {cond}.", "Vos {topic} sont {verbed} {cond}.", "Vous (pouvez~devez) {inf} vos {topic} {cond}.", "{Cond}, nous pouvons {inf} les {topic} liés à {brand}.", "Selon l'article {n}, {qui} (peut~doit) {inf} les {topic}.", "Le délai est de {n} jours pour les {topic}.", "Les cookies de {brand} sont {verbed} {cond}."],
    "Qui": ["Nous", "Nos partenaires", "La société", "{brand}", "Le service qualité"], "qui": ["la société", "l'utilisateur", "{brand}", "le prestataire"],
    "verb": ["conservons", "utilisons", "traitons", "partageons", "conserve", "utilise", "vérifie"], "inf": ["conserver", "modifier", "supprimer", "consulter", "transmettre", "demander", "bloquer"],
    "verbed": ["conservés", "supprimés", "traités", "partagés", "vérifiés"], "cond": ["pendant {n} jours", "sur demande", "avec votre accord", "avant le {date}", "si la loi l'exige", "lorsque le compte est fermé", "sans délai"],
    "Cond": ["Avec votre accord", "Dès le {date}", "Si la loi l'exige", "Après {n} jours"],
    "topic": ["données", "données de paiement", "commandes", "messages", "factures", "récépissés", "réclamations", "préférences", "adresses", "contrats", "remboursements", "événements", "fichiers", "appareils", "frais", "crédits", "avis"],
}

_ES = {
    "top": ["{start} {sep} {doc}", "{start} {sep} {section} {sep} {doc}", "(Está en~Usted está aquí): {start} {sep} {doc}", "{cookie}", "{cookie}", "{cookie}", "{byline}", "{byline}"],
    "side": ["(También le puede interesar~Lea también~Ver también~Relacionado~Recomendado)(:~ ») {topic}( en {brand}~)", "(Lo más leído~Popular~Temas del momento~Tendencias): {topic}", "(Publicidad~Anuncio)(:~ -) (pruebe~descubra) {brand} ({n} días~gratis~)", "Compartir (esta página~este artículo)(: {net} | {net}~ en {net}~)", "¿Le (resultó~ha sido) útil( esta página~)? Sí / No", "(Imprimir~Imprimir esta página)(  ~ | )(Guardar PDF~PDF~Enviar por correo)", "Comentarios ({n})", "A {n} lectores les resultó útil", "Artículo siguiente » {topic}"],
    "foot": ["© {year} {brand}. Todos los derechos reservados(.~)", "Copyright {year} {brand} S.A.", "{lk} | {lk} | {lk}", "{lk} · {lk}", "Volver arriba ↑", "Ir arriba", "(Suscríbase a~Suscríbete a) (nuestro~al) boletín(: su correo~)", "Síganos(: {net} / {net}~ en {net})", "Todos los precios incluyen IVA", "{brand} S.A., calle {brand} {n}", "Descargar la aplicación", "Una empresa del grupo {brand}"],
    "cookie": ["(Este sitio~Esta página~Nuestra web) (utiliza~usa~guarda~instala) cookies( para {purpose}~). {buttons}", "(Usamos~Utilizamos) cookies( para {purpose}~). {buttons}", "(Nosotros y {n} socios~Con {n} socios) (leemos~guardamos) (cookies~datos) en su (navegador~dispositivo). {buttons}", "(Su privacidad~Configuración de cookies~Sus opciones): {buttons}", "Si continúa navegando, acepta el uso de cookies. {buttons}"],
    "buttons": ["{button}", "{button} | {button}", "[{button}] [{button}]", "{button} {button}"],
    "button": ["Aceptar", "Aceptar todo", "Rechazar", "Rechazar todo", "Configurar", "OK", "Solo necesarias", "Más información", "¿Permitir?", "Cerrar"],
    "byline": ["Por (la redacción de ~){brand}( {brand}~)(, {date}~)", "(Publicado~Actualizado)( el~:) {date}", "(Revisado~Verificado) por (el equipo de {topic}~{brand} {brand})(, página {n}~)", "Tiempo de lectura: {n} minutos", "Leído {n} veces"],
    "start": ["Inicio", "Página principal"], "section": ["Legal", "Ayuda", "Empresa"],
    "lk": ["Aviso legal", "Privacidad", "Condiciones", "Accesibilidad", "Mapa del sitio", "Contacto", "Prensa", "Empleo", "Configurar cookies"],
    "net": ["Facebook", "correo", "copiar enlace", "WhatsApp", "fotos", "vídeos", "enlace"],
    "doc": ["Privacidad", "Política de privacidad", "Condiciones de uso", "Cookies", "Envíos", "Devoluciones", "Privacy policy"],
    "purpose": ["mejorar {topic}", "mejorar {brand}", "medir visitas", "prevenir el fraude", "personalizar el contenido"],
    "head": ["Sus derechos", "Sus opciones en {brand}", "Datos de {topic}", "(Plazos~Uso~Conservación) de {topic}( en {brand}~: {brand}~)", "Cambios en estas condiciones", "{topic} y {topic}"],
    "item": ["{topic}", "los {topic}", "sus {topic}", "{topic} y {topic}"],
    "clause": ["{sentence}", "{sentence} {sentence}"],
    "sentence": ["{Quien} {verb} {topic} {cond}.", "Sus {topic} se {verb3} {cond}.", "Usted (podrá~puede~debe) {inf} sus {topic} {cond}.", "{Cond}, podremos {inf} los {topic} de {brand}.", "Según la cláusula {n}, {quien} (podrá~deberá) {inf} los {topic}.", "El plazo es de {n} días para {topic}.", "Las cookies de {brand} se {verb3} {cond}."],
    "Quien": ["Nosotros", "Nuestros socios", "La empresa", "{brand}", "La oficina de gestión"], "quien": ["la empresa", "el usuario", "{brand}", "usted"],
    "verb": ["conservamos", "usamos", "tratamos", "compartimos", "conserva", "revisa"], "verb3": ["conservan", "eliminan", "tratan", "comparten", "revisan"], "inf": ["conservar", "modificar", "eliminar", "consultar", "transmitir", "solicitar", "bloquear", "añadir"],
    "cond": ["durante {n} días", "a petición", "con su permiso", "antes del {date}", "cuando la ley lo exija", "cuando cierre la cuenta", "por escrito"], "Cond": ["Con su permiso", "Desde el {date}", "Cuando la ley lo exija", "Después de {n} días"],
    "topic": ["datos", "datos de pago", "pedidos", "mensajes", "facturas", "reclamaciones", "preferencias", "direcciones", "contratos", "reembolsos", "eventos", "archivos", "dispositivos", "tasas", "créditos", "opiniones"],
}
GRAMMAR = {"en": _EN, **{lang: {"sep": _EN["sep"]} | rules for lang, rules in (("de", _DE), ("fr", _FR), ("es", _ES))}}
_SYLLABLES = [a + b for a in "b c d f g k l m n p r s t v z br pr tr st".split() for b in "a e i o u an el in or ar".split()]
_CHOICE = re.compile(r"(?<!\\)\(([^()~]*(?:\\[()][^()~]*)*~(?:[^()\\]|\\[()])*)\)(?!\w)|(?<!\\)\(([^()~]*)\)\?")
_NAME = re.compile(r"\{(\w+)(\??)\}")
_MONTHS = {"en": "January February March April May June July August September October November December", "de": "Januar Februar März April Mai Juni Juli August September Oktober November Dezember", "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre", "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre"}


class Writer:
    """Writes lines of a language by the grammar."""

    def __init__(self, rng: random.Random, lang: str):
        self.rng, self.lang, self.rules = rng, lang, GRAMMAR[lang]

    def brand(self) -> str:
        return "".join(self.rng.choice(_SYLLABLES) for _ in range(self.rng.randint(2, 3))).capitalize()

    def date(self) -> str:
        r, day, month, year = self.rng, self.rng.randint(1, 28), self.rng.randint(1, 12), self.rng.randint(2005, 2026)
        name = _MONTHS[self.lang].split()[month - 1]
        return r.choice([f"{day} {name} {year}", f"{day} {name}", f"{name} {day}, {year}", f"{name} {year}", f"{day}.{month}.{year}", f"{day}/{month}/{year}", f"{year}-{month:02d}-{day:02d}", f"{day}. {name} {year}"])

    def value(self, name: str) -> str:
        r = self.rng
        if name == "n":
            return str(r.randint(1, 10 ** r.randint(1, 4)))
        if name == "year":
            return str(r.randint(1998, 2027))
        if name == "code":
            return r.choice([f"{r.choice('ABCDHKMRTW')}{r.choice('BRSXZ')}-{r.randint(1, 99999)}", f"{r.getrandbits(40):x}", str(r.randint(10**5, 10**8))])
        if name in ("brand", "date"):
            return getattr(self, name)()
        if name == "Topic":
            return self.value("topic").capitalize()
        return self.write(r.choice(self.rules[name]))

    def write(self, rule: str) -> str:
        while _CHOICE.search(rule):
            rule = _CHOICE.sub(lambda m: self.rng.choice(m.group(1).split("~")) if m.group(1) is not None else self.rng.choice(["", m.group(2)]), rule)
        rule = rule.replace("\\(", "(").replace("\\)", ")")
        return _NAME.sub(lambda m: "" if m.group(2) and self.rng.random() < 0.5 else self.value(m.group(1)), rule)

    def line(self, name: str) -> str:
        """A line of a kind; what was left out leaves no gaps, but for those meant."""
        x = re.sub(r" +([.,;:?])(?=\s|$)", r"\1", re.sub(r"(?<=\S) (?= \S)(?! \S+  )", "", self.value(name))) if name not in ("links", "share") else self.value(name)
        return x.strip() or self.line(name)

    def menu(self) -> list[str]:
        items = [self.write(x) for x in self.rng.sample(MENUS[self.lang], min(self.rng.randint(1, 11), len(MENUS[self.lang])))]
        way = self.rng.randrange(10)
        if way < 3:
            return items
        if way == 3:
            sign = self.rng.choice(["» ", "› ", "- ", "• ", "> ", "▸ "])
            return [sign + x for x in items]
        joined = self.rng.choice([" | ", " · ", "  ", "\t", " / ", " • ", " - ", " › "]).join(items)
        return [f"* {joined} *" if self.rng.random() < 0.1 else joined]

    def body(self) -> list[tuple[str, str]]:
        """(innermost tags, line) of the main text."""
        r, rows = self.rng, []
        for _ in range(r.randint(1, 4)):
            if r.random() < 0.6:
                number = r.choice(["", "", f"{r.randint(1, 28)}. ", f"{r.randint(1, 28)}.{r.randint(1, 28)} ", f"§ {r.randint(1, 40)} "])
                named = r.choice(["", "", "", ": {}", " ({})", ", {}"]).format(self.brand())  # what a section is about
                rows.append(("h2", number + self.line("head") + named))
            rows += [("p", self.line("clause")) for _ in range(r.randint(0, 3))]
            if r.random() < 0.4:
                if r.random() < 0.6:  # a sentence that leads to a list
                    rows.append(("p", self.line("sentence").rstrip(".") + ":"))
                mark, end = r.choice(["- ", "• ", "* ", "", "{}) ", "({}) ", "{}. "]), r.choice(["", "", ";", ",", "."])
                for k in range(r.randint(1, 5)):
                    more = r.choice(["", "", "", ", {n} (days~entries~items)", " ({brand})", " ({n})"]) if self.lang == "en" else ""
                    rows.append(("ul li", mark.format(r.choice([chr(97 + k), k + 1, r.randint(1, 30)])) + self.line("item") + self.write(more) + end))
            if r.random() < 0.2:
                rows.append(("p", r.choice(LEFTOVERS)))
        return rows


LEFTOVERS = [x for kind, x in EXEMPLARS if kind != "policy"]


# Ancestors of blocks in common page layouts, with words of their classes and ids.
PLACES = {
    "menu": ["header nav ul li a", "nav ul li a", "nav a", "div .menu ul li a", "div .navbar a", "header div .nav"],
    "top": ["header div", "div .breadcrumb", "div .breadcrumbs ol li", "div .cookie .banner", "div .consent p", "div .byline", "div .meta p", "nav ol li", "div"],
    "side": ["aside div", "aside p", "div .sidebar p", "div .related li a", "div .share a", "div .ad", "div .widget p", "div"],
    "foot": ["footer div", "footer p", "footer ul li a", "div .footer p", "div .copyright", "div .social a", "div"],
}
MAIN = ["main section", "main article", "article", "div .content", "main", "div .main .article", "div .entry .content", "body div"]


def page(rng: random.Random) -> list[tuple[str, str, bool]]:
    """(ancestor tags, line, whether around the main text) of one page; most pages carry no tags."""
    w = Writer(rng, rng.choice(["en", "en", "en", "en", "de", "fr", "es"]))
    tagged = rng.random() < 0.3
    rows: list[tuple[str, str, bool]] = []

    def add(tags: str, lines: list[str], around: bool) -> None:
        for x in lines:
            r = rng.random()
            x = x.upper() if r < 0.06 else x.lower() if r < 0.1 else f"{'  ' * rng.randint(0, 1)}{x} " if r < 0.15 else x
            rows.append((tags if tagged else "", x, around))

    if rng.random() < 0.55:
        for part in rng.sample(["menu", "top", "top", "side"], rng.randint(1, 3)):
            add(rng.choice(PLACES[part]), w.menu() if part == "menu" else [w.line(part) for _ in range(rng.randint(1, 3))], True)
    if rng.random() < 0.95:
        home = rng.choice(MAIN)
        for tags, x in w.body():
            add(f"{home} {tags}", [x], False)
            if rng.random() < 0.05:
                add(rng.choice(PLACES["side"]), [w.line(rng.choice(["side", "side", "top"]))], True)
    if rng.random() < 0.5:
        for part in rng.sample(["side", "foot", "foot", "menu"], rng.randint(1, 3)):
            add(rng.choice(PLACES[part]), w.menu() if part == "menu" else [w.line(part) for _ in range(rng.randint(1, 3))], True)
    return rows


def labelled_pages(pages: int = 2500, seed: int = 11) -> list[list[tuple[str, str, bool]]]:
    rng = random.Random(seed)
    return [p for p in (page(rng) for _ in range(pages)) if p]
